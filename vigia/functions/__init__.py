"""Column expressions; all built from Spark SQL functions, none from Python UDFs."""
