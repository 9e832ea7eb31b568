"""Relational and ML operators, each a function over DataFrames."""
