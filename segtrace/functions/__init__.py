"""Column functions: text, distributions and fixed domain values."""
