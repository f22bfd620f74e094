"""Operators of a training-data pipeline: filtering, deduplication, mixing, formatting.

Nothing else in the library imports this subpackage.  ``queries`` holds one
registered query per operator and its SQL.
"""
