"""Operators for building training corpora at scale.

Every operator takes and returns DataFrames. Nothing outside this subpackage
imports it; the rest of the library works without it.
"""
