"""Structured Streaming: draining queries into the shared folder and the
stateful (``transformWithStateInPandas``) forms of the keyed operators."""

from tidewater.streaming.batched_state import running_batches, stream_running_batches
from tidewater.streaming.drain import drain, drain_timers
from tidewater.streaming.sinks import (RowSink, fan_out_stream, observed_batches, route_stream,
                                      row_sink_stream)
from tidewater.streaming.stateful import (processing_time_window_counts, stream_changelog,
                                          stream_enrich, stream_keyed_reduce, stream_running_sum)

__all__ = ["running_batches", "stream_running_batches", "drain", "drain_timers", "RowSink", "observed_batches", "fan_out_stream", "row_sink_stream", "route_stream",
           "stream_keyed_reduce", "processing_time_window_counts", "stream_changelog",
           "stream_enrich", "stream_running_sum"]
