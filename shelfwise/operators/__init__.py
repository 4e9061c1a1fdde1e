"""DataFrame operators: plain functions from DataFrames to a lazy DataFrame."""
