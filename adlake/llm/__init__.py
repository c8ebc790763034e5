"""Operators for preparing training text: deduplication, filtering, formatting, packing."""
