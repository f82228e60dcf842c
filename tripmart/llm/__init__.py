"""Operators for large text corpora used as training data.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
