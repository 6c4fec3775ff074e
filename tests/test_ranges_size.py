"""Ranges of the running sums are written sorted, so that a key's rows stand together."""

from pyspark.sql import functions as F

from tidewater.operators.running import _ranges


def test_ranges_are_written_in_order(spark):
    df = spark.range(20_000).select((F.xxhash64("id") % 7).alias("k"), F.xxhash64(F.col("id"), F.lit(1)).alias("o"))
    got = _ranges(df, ["k", "o"], 4).orderBy("__part", "__at").collect()
    assert len({r["__part"] for r in got}) > 1 and len(got) == 20_000
    assert [(r.k, r.o) for r in got] == sorted((r.k, r.o) for r in got)
