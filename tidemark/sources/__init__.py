"""Readers of landed data: JSON pages, JSONP responses, HTML pages, media files and stored documents."""
