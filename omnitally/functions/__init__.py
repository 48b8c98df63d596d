"""Column expressions shared by the operators (all built-in Spark functions)."""
