"""Operators for preparing training text: deduplication, cleaning, token counts, archives."""
