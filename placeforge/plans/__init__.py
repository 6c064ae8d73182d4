"""Place-reputation analytics on Spark: plans."""
