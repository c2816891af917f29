"""Incremental maintenance of the vector table with Structured Streaming."""
