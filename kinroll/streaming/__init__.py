"""The roll-up over a stream of hits. The reference has no streams; this only
runs the same operator incrementally."""

from kinroll.streaming.rollup_stream import start_rollup_stream, stream_parent_rollup

__all__ = ["start_rollup_stream", "stream_parent_rollup"]
