"""Structured Streaming forms of the batch operators that have one."""
