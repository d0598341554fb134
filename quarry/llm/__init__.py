"""Corpus operators for training-data preparation: fingerprints, web archives,
toxicity, language identification, main-text extraction, vector search, line
deduplication, similarity joins, source mixing and tokenisation.

Nothing else in the library imports this subpackage.  ``queries.py`` registers
one query per operator.
"""
