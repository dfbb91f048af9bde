"""Structured Streaming forms of the incremental operators."""

from tabflow.streaming.streams import stream_incremental_split, stream_moments, stream_profile, stream_split_by_state, stream_upsert, streamed_profile

__all__ = ["stream_incremental_split", "stream_moments", "stream_profile", "stream_split_by_state", "stream_upsert", "streamed_profile"]
