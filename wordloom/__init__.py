"""wordloom: text-corpus analytics as Spark DataFrame jobs."""
