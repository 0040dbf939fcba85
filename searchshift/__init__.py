"""Search-index backup migration analytics as PySpark DataFrame jobs."""
