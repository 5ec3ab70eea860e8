"""lakeops: reusable PySpark operators for lakehouse star schemas."""
