"""Structured Streaming counterparts of the monitoring operators."""
