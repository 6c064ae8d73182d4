"""Place-reputation analytics on Spark: sources."""
