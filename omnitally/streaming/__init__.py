"""Structured Streaming: the event feed (webhook deliveries) as a stream."""
