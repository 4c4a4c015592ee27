"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage. Every module holds one
operator; ``queries.py`` registers one query per operator.
"""
