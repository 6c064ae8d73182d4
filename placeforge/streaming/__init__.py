"""Place-reputation analytics on Spark: streaming."""
