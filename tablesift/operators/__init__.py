"""Filters, deduplication, summaries and the quality model."""
