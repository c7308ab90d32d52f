"""Operators for large training-data pipelines (packing, language id, toxicity,
sharding, near-duplicates, decontamination, secrets, vector search, licenses,
URL filters). Nothing else in the library imports this subpackage."""
