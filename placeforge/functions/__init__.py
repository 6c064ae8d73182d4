"""Place-reputation analytics on Spark: functions."""
