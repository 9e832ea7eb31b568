"""Operators of a training-data pipeline (URL lists, search, quality, WARC,
line and near duplicates, secrets, tokens, packing).

Nothing outside this subpackage imports it; the registered queries are in
:mod:`quarry.llm.catalog`.
"""
