"""fieldhouse: sports-betting analytics as Spark DataFrame jobs."""
