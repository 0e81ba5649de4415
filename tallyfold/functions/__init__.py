"""Column functions: no job, no shuffle, everything stays inside Spark expressions."""
