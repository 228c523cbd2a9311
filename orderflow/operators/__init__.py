"""Distributed operators: every one takes and returns DataFrames."""
