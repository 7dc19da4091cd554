"""Operators of a training-data pipeline: dedup, scans, search, packing, tokenizing, extraction, language models."""
