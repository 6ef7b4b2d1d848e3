"""Change-data streams to keyed analytics tables, on Spark."""
