"""Operators for preparing training text: deduplication, decontamination, scoring, archives, packing."""
