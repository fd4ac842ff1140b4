"""Cleaning of raw files as they arrive."""

from .ingest import clean_stream

__all__ = ["clean_stream"]
