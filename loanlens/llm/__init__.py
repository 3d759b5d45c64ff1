"""Operators for preparing text corpora, and the queries that run them.

Each module holds one operator with its general interface; ``queries`` applies
each of them to its whole table.  Nothing else in the library imports this
subpackage.
"""
