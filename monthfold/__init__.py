"""Wide-to-long sales analytics on Spark."""
