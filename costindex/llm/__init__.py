"""Operators for preparing training data: deduplication, extraction, packing, filtering, tokens, archives.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.  Each
module holds one operator; ``queries.py`` binds the operators to the given
tables.
"""
