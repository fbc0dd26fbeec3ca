"""Land, building and property analytics on Spark."""
