"""Counter analytics on Spark: plain DataFrame operators with column names as parameters."""
