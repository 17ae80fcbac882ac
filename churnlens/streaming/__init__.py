"""Structured Streaming jobs."""

from churnlens.streaming.scoring import start_scoring_stream  # noqa: F401
