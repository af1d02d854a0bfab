"""Customer-retention analytics as Spark DataFrame and Spark ML jobs."""
