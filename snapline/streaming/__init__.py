"""Structured Streaming: raw sink, silver load per micro-batch, stateful variant."""
