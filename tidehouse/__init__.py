"""tidehouse: a real-time shop warehouse expressed as Spark DataFrame transforms."""
