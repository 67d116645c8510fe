"""Operators for preparing training data, and their registered queries.

Nothing outside this subpackage imports it.
"""
