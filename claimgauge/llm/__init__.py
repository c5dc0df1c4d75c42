"""Operators for large text corpora: each module has one, ``registered`` has their queries."""
