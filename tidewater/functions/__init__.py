"""Column expressions: the per-row logic of the library, all JVM-side."""

from tidewater.functions.text import characters, words
from tidewater.functions.rows import parity_tag, prefixed_string, row_kind_rows

__all__ = ["words", "characters", "parity_tag", "prefixed_string", "row_kind_rows"]
