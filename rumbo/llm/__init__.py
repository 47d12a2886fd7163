"""Operators of a training-data pipeline: scoring, fingerprints, archives, search, packing, mixing."""
