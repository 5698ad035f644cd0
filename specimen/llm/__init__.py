"""Operators of a large-scale training-data pipeline over a ``documents`` table.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its general interface and a thin query ``opN_<name>`` that
applies it to the whole table; ``registry`` collects queries and SQL.
"""
