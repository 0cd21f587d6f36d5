"""Operators for preparing training text: search, deduplication, counting, scoring, cleaning and mixing."""
