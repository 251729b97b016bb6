"""Operators for large-scale text corpora; nothing outside this folder imports it."""
