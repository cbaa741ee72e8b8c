"""Training-data operators: scoring, deduplication, filtering, sharding, encoding and packing of documents.

Nothing outside this subpackage imports it.  Each module holds one operator; `queries` registers them.
"""
