"""Operators for preparing training data: quality, duplicates, languages, packing, leaks, filters, shards."""
