"""Operators for preparing training text: packing, cleaning, deduplication, scoring, tokens."""
