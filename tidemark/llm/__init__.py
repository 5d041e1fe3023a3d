"""Operators on training text: licences, chats, search, URLs, toxicity, duplicates, mixing, packing, private data."""
