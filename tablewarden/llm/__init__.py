"""Operators for training-data corpora.

One module per operator; ``queries`` registers the thin ``opN_*`` queries over ``documents`` and ``sqls``
holds their DuckDB text. Nothing outside this subpackage imports it.
"""
