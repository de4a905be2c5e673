"""Operators of a large-scale training-data pipeline (cleaning, near-duplicate
and substring deduplication, mixing, tokenisation, classification, search).

Nothing outside this subpackage imports it. Every operator takes and returns
DataFrames; ``queries`` holds the registered ``opN_<name>`` queries.
"""
