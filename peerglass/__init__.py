"""Company screening and valuation as Spark jobs."""
