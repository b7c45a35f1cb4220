"""Operators for preparing training text: dedup, archives, sharding, search, models, tokens.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
