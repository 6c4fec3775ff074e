"""tidewater: keyed stream-and-table operators on Spark DataFrames."""

from tidewater.session import get_session, scratch_path, shared_dir

__all__ = ["get_session", "shared_dir", "scratch_path"]
