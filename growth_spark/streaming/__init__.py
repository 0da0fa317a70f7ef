"""Live series and frame chunks by Structured Streaming."""
