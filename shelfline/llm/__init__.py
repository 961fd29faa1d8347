"""Operators for preparing training text: mixing, quality, tokens, secrets, licences, duplicates and privacy."""
