"""Training-data pipeline operators: dedup, language id, packing, tokens, search.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
