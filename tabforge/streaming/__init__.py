"""Structured Streaming scoring."""

from tabforge.streaming.score import start_scoring_stream  # noqa: F401
