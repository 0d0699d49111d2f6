"""Relational and time-series operators over bar DataFrames."""
