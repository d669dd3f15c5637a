"""The analytics, as functions from DataFrames to DataFrames."""
