"""Operators for training data: rules, duplicates, leaks, secrets, licences, shards and tokens."""
