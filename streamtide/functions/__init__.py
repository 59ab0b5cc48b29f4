"""Column functions. All of them stay inside Spark's own expressions."""
