"""Operators for preparing training text: deduplication, filtering, tokenising, scoring."""
