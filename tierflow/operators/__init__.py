"""Relational operators over DataFrames."""
