"""Structured Streaming: telemetry and incremental tiling."""
