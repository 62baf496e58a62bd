"""Idempotent writers: archive, keyed store, search index, CSV export."""
