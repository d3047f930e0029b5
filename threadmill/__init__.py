"""Discussion-archive analytics as Spark DataFrame jobs."""
