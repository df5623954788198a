"""Incremental state: which province pages belong to the next batch."""
