"""Operators for preparing training data: counting, deduplication, quality, scoring, mixing, packing."""
