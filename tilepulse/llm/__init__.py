"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``benchmark``.

Nothing outside this subpackage imports it. ``queries.py`` holds the registered queries and
``oracle.py`` their DuckDB SQL; each other module is one operator with a general interface
(a DataFrame in, a DataFrame out, column names as parameters).
"""
