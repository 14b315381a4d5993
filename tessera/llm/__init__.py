"""Operators of a training-data pipeline over the text, page and vector tables.

Each module holds one operator with a general interface plus the thin
registered query ``opN_<name>``; ``catalog`` collects the queries and their SQL.
Nothing outside this subpackage imports it.
"""
