"""Running a DataFrame transform as a streaming query."""

from metricloom.streaming.runner import preview_stream, run_stream, stream_to_table, stream_to_topic

__all__ = ["preview_stream", "run_stream", "stream_to_table", "stream_to_topic"]
