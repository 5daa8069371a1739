"""Table writes that can be run again without changing the result."""
