"""DataFrame -> DataFrame operators.  Each works on batch DataFrames; those
marked in their docstrings also work on streams."""

from tidewater.operators.aggregate import count_by, keyed_reduce, keyed_sum, observed_count
from tidewater.operators.joins import enrich, fits_broadcast, latest_by_key
from tidewater.operators.ordered import enrich_in_order, ordered_reduce, running_reduce
from tidewater.operators.rowops import (Routed, connect_map, drop_value, fan_out, fan_out_files,
                                        map_partitions_with_setup, route, with_local_count, with_one)
from tidewater.operators.running import (changelog_insert_only, changelog_sum, running_sum,
                                         running_sums)
from tidewater.operators.setops import union_all
from tidewater.operators.tokenize import tokenize_chars, tokenize_words
from tidewater.operators.windows import processing_time_window, tumbling_aggregate

__all__ = [
    "count_by", "keyed_reduce", "keyed_sum", "observed_count", "enrich", "fits_broadcast",
    "latest_by_key", "enrich_in_order", "ordered_reduce", "running_reduce", "Routed", "connect_map", "drop_value", "fan_out", "fan_out_files", "map_partitions_with_setup",
    "route", "with_local_count", "with_one", "changelog_insert_only", "changelog_sum",
    "running_sum", "running_sums", "union_all", "tokenize_chars", "tokenize_words",
    "processing_time_window", "tumbling_aggregate",
]
