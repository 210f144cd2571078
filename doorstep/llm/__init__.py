"""Operators of a training-data pipeline: filtering, deduplication, archives, mixing and token files."""
