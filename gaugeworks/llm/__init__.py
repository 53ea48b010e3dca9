"""Operators for preparing training data: cleaning, duplicates, search, sharding and tokens."""
