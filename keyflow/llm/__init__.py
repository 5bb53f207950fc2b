"""Operators of a training-data pipeline (documents, pages, benchmark, labels).

Each module holds one operator; ``queries`` registers the thin ``opN_*``
queries and their SQL.  Nothing else in the library imports this package.
"""
