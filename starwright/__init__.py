"""A dimensional sales warehouse expressed as Spark jobs."""
