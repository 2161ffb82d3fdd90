"""Column expressions and column names."""
