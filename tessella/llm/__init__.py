"""Operators for preparing language-model training corpora.

Nothing outside this subpackage imports it.  Each operator takes a DataFrame and
column names, so tables with further columns (also ones whose names clash with the
operators' own working columns) pass through unchanged.
"""
