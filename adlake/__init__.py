"""Ad attribution on a lakehouse, expressed as PySpark DataFrame operations."""
