"""Data operators: DataFrames in, DataFrames out, no job started."""
