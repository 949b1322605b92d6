"""Operators of a training-data pipeline: text, tokens, pages and vectors."""
