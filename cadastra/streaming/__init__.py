"""Incremental runs over streams of new rows."""
