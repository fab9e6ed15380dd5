"""Incremental forms of the article jobs."""
