"""Labour-compliance warehouse analytics as plain PySpark DataFrame jobs."""
