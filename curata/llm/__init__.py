"""Operators for preparing training data.

Nothing outside this subpackage (but corpus_pipeline.py and the guarded part of
__spark_entry__.py) imports it.
"""
