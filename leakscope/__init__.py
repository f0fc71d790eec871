"""Claims severity and leakage analytics as Spark jobs."""
