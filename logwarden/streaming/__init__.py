"""Real-time detection with Structured Streaming."""
