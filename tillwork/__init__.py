"""Commerce analytics on Spark: bronze, silver and gold layers, metrics and reports."""
