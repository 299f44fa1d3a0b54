"""Municipality-by-year panel operators, cleaning jobs and panel queries on Spark."""
