"""DataFrame operators: they take DataFrames and return DataFrames, and stay lazy unless they say otherwise."""
