"""Operators for preparing language-model training data at scale.

Every operator maps DataFrames to DataFrames, reads whole texts and all rows, and states in its docstring what it does with
NULLs, empty and very long texts, ties and repeated rows, empty tables and extra columns. Nothing else in the library
imports this subpackage.
"""
