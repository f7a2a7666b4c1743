"""Published-statistics ingestion and revision analytics as plain Spark DataFrame functions."""
