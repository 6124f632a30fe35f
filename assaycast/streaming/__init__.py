"""File replay with Structured Streaming."""
