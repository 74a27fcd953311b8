"""Pipeline-health analytics as Spark DataFrame, window and streaming jobs."""
