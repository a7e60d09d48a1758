"""Relational operators: filters, deduplication, cursors, joins and member statistics."""
