"""Structured Streaming forms of the pipelines (same transformation code as
batch; sources, sinks, watermarks and checkpoints differ)."""
