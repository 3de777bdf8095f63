"""Structured Streaming forms of the delivery and monitoring operators."""
