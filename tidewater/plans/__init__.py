"""Query plans: the library's operators composed over the driver tables,
one function ``(spark, sf_dir) -> DataFrame`` per registered query."""

from tidewater.plans.queries import QUERIES
from tidewater.plans.oracles import ORACLES

__all__ = ["QUERIES", "ORACLES"]
