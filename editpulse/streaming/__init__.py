"""Streaming queries: sources, sinks, checkpoints and triggers."""
