"""Column expressions and the exact quantile aggregate."""
