"""Incremental (Structured Streaming) form of the day roll-up."""

from dealcast.streaming.rollup import read_rollup_state, stream_daily_rollup  # noqa: F401
