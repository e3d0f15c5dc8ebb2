"""Structured Streaming forms: watermarked sources, sinks and keyed state machines."""
