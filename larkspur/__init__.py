"""larkspur: review, listing and recipe analytics as PySpark DataFrame jobs."""
