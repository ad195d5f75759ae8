"""DataFrame operators. Each takes DataFrames and returns DataFrames."""
