"""Structured Streaming jobs: window sink, clean/quality/anomaly sink, runners."""
