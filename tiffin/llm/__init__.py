"""Operators of a training-data pipeline: tokens, mixing, search, de-duplication, languages."""
