"""Relational and statistical operators: DataFrames in, DataFrames out."""
