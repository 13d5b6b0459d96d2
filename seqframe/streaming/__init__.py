"""Structured Streaming: index newly arriving text with fitted vocabularies."""

from seqframe.streaming.indexing import index_stream, start_indexing

__all__ = ["index_stream", "start_indexing"]
