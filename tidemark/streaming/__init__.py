"""Running the incremental merge as deltas arrive (Structured Streaming)."""

from tidemark.streaming.delta_feed import start_merge_stream, start_merge_stream_table

__all__ = ["start_merge_stream", "start_merge_stream_table"]
