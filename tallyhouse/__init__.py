"""tallyhouse: operations analytics as plain Spark DataFrame functions."""
