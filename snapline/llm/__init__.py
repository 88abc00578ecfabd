"""Operators of a training-data pipeline: near-duplicate join, token counts, source mixing,
fingerprints, packed token files, language-model quality, personal data, page text,
quality rules and sequence packing. Nothing else in the library imports this package."""
