"""Operators for preparing training text: filters, near-duplicates, models,
tokens, shards and mixes. Nothing else in the library imports this package."""
