"""City-operations analytics as PySpark jobs."""
