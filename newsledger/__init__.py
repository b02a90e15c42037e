"""Spark DataFrame and Structured Streaming operators for document intelligence."""
