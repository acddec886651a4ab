"""Training-data operators: dedup, sharding, extraction, scoring, packing, search.

Each module holds one operator with a general DataFrame-in / DataFrame-out
interface; ``catalog`` registers the ``opN_*`` queries over the given tables.
Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
