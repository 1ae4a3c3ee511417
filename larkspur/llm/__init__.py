"""Operators for preparing training text: scoring, matching, mixing, packing."""
