"""Operators for preparing training text: quality, deduplication, archives, chat, packing, filters, mixing."""
