"""End-to-end jobs, DataFrames in and DataFrames out."""
