"""Operators of a training-data pipeline: dedup, language, personal data, toxicity, mixing, packing."""
