"""Column-expression helpers (pure ``pyspark.sql.functions`` compositions)."""
