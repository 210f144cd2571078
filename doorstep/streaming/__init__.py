"""Structured Streaming: the delivery event feed."""
