"""Incremental (exactly-once) file loads on Structured Streaming."""
