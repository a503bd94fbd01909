"""Operators for preparing training data, one module each.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; the thin registered queries live in ``queries``.
"""
