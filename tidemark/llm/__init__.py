"""Operators of a training-data pipeline: filtering, deduplication, packing and encoding of text at scale."""
