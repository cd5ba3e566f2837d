"""Column functions: every one maps columns to a column with built-in expressions."""
