"""Credit-risk analytics as Spark DataFrame operators and batch plans."""
