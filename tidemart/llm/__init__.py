"""Operators of a training-data pipeline: mixing, scoring, filters and near-duplicate joins.

Nothing else in the library imports this package.  ``queries`` registers one
query per operator; each operator module has its own general interface.
"""
