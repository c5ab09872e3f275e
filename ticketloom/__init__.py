"""Support-knowledge analytics as PySpark DataFrame jobs."""
