"""Training-data operators: tokenising, deduplication, filtering, packing and archives.

Each module holds one operator with a general interface; ``queries`` applies them
to the given tables.  Nothing outside this subpackage imports it.
"""
