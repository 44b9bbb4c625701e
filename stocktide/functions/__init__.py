"""Column expressions. All are built from Spark functions and stay inside generated code."""
