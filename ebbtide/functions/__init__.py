"""Column expressions: they take columns and return columns, and start no job."""
