"""Network-flow analytics expressed as Spark jobs."""
