"""Operators for preparing training text, each a function over DataFrames."""
