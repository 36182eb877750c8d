"""Incremental Bronze -> Silver with Structured Streaming."""

from aerolake.streaming.incremental import incremental_silver

__all__ = ["incremental_silver"]
