"""Incremental runs on Structured Streaming; batch and stream share their functions."""
