"""Structured Streaming forms of the batch operators (incremental scoring)."""

from tabforge.streaming.scoring import score_stream

__all__ = ["score_stream"]
