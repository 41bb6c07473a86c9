"""Operators for large training-data pipelines.

Each module holds one operator with its own general interface; ``queries.py``
holds the thin registered queries, ``oracles.py`` their DuckDB SQL.  Nothing
outside this subpackage imports it.
"""
