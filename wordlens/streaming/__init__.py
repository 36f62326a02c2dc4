"""Structured Streaming form of the keyword statistics."""

from wordlens.streaming.keyword_stream import running_keyword_stats, start_keyword_stream

__all__ = ["running_keyword_stats", "start_keyword_stream"]
