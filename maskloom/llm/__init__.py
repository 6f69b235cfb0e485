"""Operators for corpora of texts: counting, scoring, scanning, archives and duplicates."""
