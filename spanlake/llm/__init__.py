"""Operators that prepare training text: filtering, deduplication, extraction, scoring, mixing, token files, packing."""
