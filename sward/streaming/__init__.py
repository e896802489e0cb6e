"""The assessment log as Structured Streaming queries."""
