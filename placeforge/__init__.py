"""Place-reputation analytics on Spark: placeforge."""
