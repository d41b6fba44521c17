"""Operators for text corpora and large groups; nothing outside imports this package."""
