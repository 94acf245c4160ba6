"""Operators for preparing text corpora, one module each, and their registered queries.

Nothing outside this folder imports it, so it can be removed as a whole.
"""
