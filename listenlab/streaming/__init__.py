"""Continuous ingest: the clean step over a stream of JSON event files."""

from .ingest import start_clean_ingest

__all__ = ["start_clean_ingest"]
