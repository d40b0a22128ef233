"""City mobility analytics as Spark jobs."""
