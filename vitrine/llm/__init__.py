"""Training-data operators: deduplication, tokenising, scoring, filtering and mixing of text corpora.

Each module holds one operator with a general interface; `queries.py` applies
them to the test tables.  Nothing outside this folder (but for
`__spark_entry__.py` and `corpus_pipeline.py`) imports it.
"""
