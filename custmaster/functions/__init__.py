"""Column expressions and code maps (built-in Spark functions only)."""
