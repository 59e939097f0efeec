"""Full-text indexing and ranked keyword search as Spark DataFrame jobs."""
