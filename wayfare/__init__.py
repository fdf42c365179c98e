"""Travel and review analytics as Spark jobs."""
