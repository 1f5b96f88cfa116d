"""Incremental file landing into bronze with Structured Streaming."""
