"""Operators for training data: cleaning, deduplication, mixing, tokens, search."""
