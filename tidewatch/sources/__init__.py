"""Readers: message streams and files, CSV tables, archive, stats, class map."""
