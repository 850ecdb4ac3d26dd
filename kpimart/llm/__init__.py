"""Operators for training-data pipelines: fingerprints, near-duplicates, search,
packing, quality, personal data, chat rendering, mixing, toxicity, token files.

Nothing else in the library imports this subpackage.
"""
