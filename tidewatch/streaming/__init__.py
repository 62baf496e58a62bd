"""Structured Streaming jobs: replay source, watermark dedup, fan-out, device state."""
