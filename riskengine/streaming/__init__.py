"""Structured Streaming queries over files or Kafka."""
