"""Operators for large training-data pipelines (near-duplicates, personal data, licenses,
contamination, secrets, tokens, HTML, mixing, languages).

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
