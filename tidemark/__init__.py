"""Tidemark: incremental ingestion and analysis of landed timelines and archives on Spark."""

__version__ = "0.1.0"
