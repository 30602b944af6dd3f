"""Operators for preparing training data: filters, scoring, near duplicates, tokens and packing."""
