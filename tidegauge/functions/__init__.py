"""Column expressions and SQL-callable functions."""
