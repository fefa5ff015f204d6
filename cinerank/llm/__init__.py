"""Training-data operators: deduplication, scoring, mixing, search, sharding, extraction.

One module per operator (``opN_*.py``), each with its general interface; the
registered queries that bind them to the driver's tables are in ``queries.py``.
Nothing outside this sub-package and ``corpus_pipeline.py`` imports it.
"""
