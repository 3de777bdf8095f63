"""Stream-ingestion analytics as ordinary Spark DataFrame and Structured Streaming jobs."""
