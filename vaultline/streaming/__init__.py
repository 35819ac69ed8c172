"""Transaction events: flags, routes, windows and alerts with Structured Streaming."""
