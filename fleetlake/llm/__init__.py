"""Operators that prepare training text: dedup, mixing, sharding, scoring, extraction, encoding."""
