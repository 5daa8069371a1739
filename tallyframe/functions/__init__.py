"""Column functions: each takes and returns Spark columns, with no Python per row."""
