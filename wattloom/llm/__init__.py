"""Operators of a training-data pipeline: dedup, tokens, packing, shards, quality, pages, search."""
