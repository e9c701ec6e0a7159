"""Incremental refreshes, and Structured Streaming as an extension."""
