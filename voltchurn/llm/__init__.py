"""Operators for a large training-data pipeline (texts, urls, vectors, tokens)."""
