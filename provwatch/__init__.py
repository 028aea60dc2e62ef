"""Provider-risk analytics as Spark DataFrame jobs."""
