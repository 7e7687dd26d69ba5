"""The operators as Structured Streaming queries."""
