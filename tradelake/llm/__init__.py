"""Operators for preparing training text at scale.

Each module holds one operator with a general interface over DataFrames; ``queries`` binds them to the
tables of a data folder.  Nothing outside this subpackage imports it.
"""
