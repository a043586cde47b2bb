"""Structured Streaming jobs: request scoring and windowed drift."""
