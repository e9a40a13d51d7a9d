"""Positions of rows in an order, without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonehour.session import scratch_path

_IN_RANGE_BITS = 33  # monotonically_increasing_id holds the place in a partition in its lower bits


def dense_positions(df: DataFrame, order: Sequence[Column], within: Sequence[str] = (), name: str = "position") -> DataFrame:
    """``df`` with the place of each row, counted from 0 in ``order``, as the
    bigint column ``name`` (one of that name in ``df`` is replaced).

    The rows are sorted into ranges, a distributed sort, and written to the
    shared scratch folder with the number of their range and their place in
    it; a lost executor re-reads these files. Only the ranges' row counts, one
    per shuffle partition, are summed up in one task. ``within`` starts the
    count anew for each value of its columns, which must lead ``order``; null
    is a value. Rows that tie in ``order`` share a range, so give an order
    that tells them apart if there may be many.
    """
    spark = df.sparkSession
    columns = [c for c in df.columns if c != name]
    place = F.monotonically_increasing_id()
    path = scratch_path(spark, "positions")
    df.select(*columns).orderBy(*order).withColumn("_at", place).write.parquet(path)
    placed = spark.read.parquet(path)
    span = F.shiftright("_at", _IN_RANGE_BITS).cast("int")
    step = F.col("_at").bitwiseAND(F.lit((1 << _IN_RANGE_BITS) - 1))
    ranges = placed.groupBy(span.alias("_span")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_span")) - F.col("_n")
    offsets = F.broadcast(ranges.select("_span", before.alias("_before")))  # a row per shuffle partition at most
    out = placed.join(offsets, span == F.col("_span")).withColumn(name, (F.col("_before") + step).cast("bigint"))
    if within:
        starts = out.groupBy(*[F.col(c).alias(f"_in_{c}") for c in within]).agg(F.min(name).alias("_start"))
        same = [out[c].eqNullSafe(F.col(f"_in_{c}")) for c in within]
        out = out.join(starts, same).withColumn(name, F.col(name) - F.col("_start"))
    return out.select(*columns, name)
