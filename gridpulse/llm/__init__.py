"""Training-data operators: scoring, deduplication, filtering, mixing and encoding of documents.

Nothing outside this subpackage imports it. Every operator takes DataFrames and
returns DataFrames; ``queries`` holds the registered entry points.
"""
