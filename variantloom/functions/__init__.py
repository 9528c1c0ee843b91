"""Column expressions and numerical functions."""
