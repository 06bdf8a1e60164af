"""Claims attribution, organisation hierarchies and scan pruning on Spark."""
