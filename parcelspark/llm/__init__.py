"""Training-data operators: tokenization, language id, sharding, PII, toxicity,
quality, decontamination, token files, line dedup and near-duplicate detection.

Nothing else in the library imports this subpackage.
"""
