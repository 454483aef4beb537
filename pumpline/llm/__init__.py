"""Operators for cleaning, filtering and mixing training text at corpus scale.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
