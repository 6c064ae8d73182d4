"""Place-reputation analytics on Spark: operators."""
