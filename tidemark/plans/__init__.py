"""The analytic workloads, each one a function from DataFrames to a DataFrame."""
