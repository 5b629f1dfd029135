"""Operators for training-data pipelines: quality, duplicates, licences, tokens, mixing, pages and urls."""
