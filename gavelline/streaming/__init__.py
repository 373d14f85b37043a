"""The incremental runs as Structured Streaming queries."""
