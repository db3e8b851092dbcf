"""Operators for building training data at scale.

One module per operator; ``registry`` holds their queries and DuckDB oracles.  Nothing
outside this folder (and ``corpus_pipeline.py``) imports it.
"""
