"""Operators for training-data pipelines: one module for each operator.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
