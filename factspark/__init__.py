"""Turn raw document collections into a scored, searchable table of facts, on Spark."""
