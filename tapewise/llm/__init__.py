"""Training-data operators: filtering, deduplication, extraction, packing and storage of text corpora.

Nothing else in the library imports this package; its registered queries are
in ``queries.py``.
"""
