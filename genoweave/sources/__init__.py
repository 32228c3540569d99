"""Readers and writers: delimited files, matrices, variant call files, catalog tables."""
