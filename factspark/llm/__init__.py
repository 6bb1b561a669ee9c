"""Operators for preparing large text collections: dedup, search, tokens, quality, mixing."""
