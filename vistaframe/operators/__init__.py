"""Operator modules; each function maps DataFrames to a lazy DataFrame."""
