"""Operators for preparing language-model training data, one module each.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; `registry` holds the queries over the given tables.
"""
