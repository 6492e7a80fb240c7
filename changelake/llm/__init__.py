"""Operators for large text corpora.

Nothing outside this package imports it.  Every operator takes and returns
DataFrames; ``queries`` registers one query per operator.
"""
