"""Community-discussion trend analytics on Spark."""
