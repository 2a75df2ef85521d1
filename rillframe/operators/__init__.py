"""Operators on DataFrames, with the names of key, order and value columns as arguments."""
