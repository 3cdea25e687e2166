"""Operators for preparing training corpora: deduplication, filtering, mixing, counting and packing of documents.

Every operator takes a DataFrame and the names of its columns; `queries` binds them to the given tables.
"""
