"""Column functions: pure expressions, no jobs."""
