"""Operators for building language-model training data.

Nothing else in the library imports this package.  Every operator takes and
returns DataFrames; ``queries`` registers one query per operator.
"""
