"""Account master and activation steps as Spark DataFrame jobs."""
