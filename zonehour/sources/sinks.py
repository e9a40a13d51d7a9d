"""Sinks (K1-K5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, by: str | Sequence[str], layout: str = "rebalance", mode: str = "static") -> None:
    """K1: overwrite ``path`` with one directory per value of ``by``. With
    ``mode="dynamic"`` only the directories that ``df`` has rows for are
    replaced; see ``overwrite_dates``.

    ``layout`` picks how rows reach the writers:

    * ``"rebalance"`` (default): one hash shuffle on ``by``, re-sized by AQE
      from the real map output. Hot dates are split over as many writers as
      their bytes need, and small dates are merged, so files land near
      ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` whatever the order
      of the input. It needs no sampling pass (unlike a range layout), and a
      retried task writes the same rows. The splitting and merging come from
      AQE (``spark.sql.adaptive.enabled``, on by default). With AQE off the
      hint is a plain hash repartition on ``by``.
    * ``"local"``: no shuffle. Each task sorts its own rows by ``by`` and
      writes one file per value it holds. Only for input that is known to be
      clustered by date (trip files written in time order), where that is
      about one file per task; other input gives up to tasks × dates files.
    """
    cols = [by] if isinstance(by, str) else list(by)
    if layout == "rebalance":
        laid_out = df.hint("rebalance", *cols)
    elif layout == "local":
        laid_out = df.sortWithinPartitions(*cols)
    else:
        raise ValueError(f"unknown layout {layout!r}")
    laid_out.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*cols).parquet(path)


def overwrite_dates(df: DataFrame, path: str, by: str, dates: Sequence[str], layout: str = "rebalance") -> None:
    """K1 for a re-run: the directories of ``dates`` in the table at ``path``
    become the rows of ``df`` with these dates; all others stay as they are,
    file by file. A date without rows loses its directory. Run again after a
    failure, it ends in the same table.

    The dates that have rows are counted first (one column of ``df``, a row
    per date), so that the others can be told from a write that never came.
    """
    spark, wanted = df.sparkSession, sorted({str(d) for d in dates})
    rows = df.where(F.col(by).cast("date").isin([F.lit(d).cast("date") for d in wanted]))
    present = {str(r[0]) for r in rows.select(F.col(by).cast("date")).distinct().collect()}
    if present:
        write_partitioned(rows, path, by, layout, mode="dynamic")
    for d in wanted:
        if d not in present:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{by}={d}")
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_table(df: DataFrame, path: str) -> None:
    """K2: plain parquet, overwrite."""
    df.write.mode("overwrite").parquet(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """K3: header CSV, overwrite. The metrics table has one row per model,
    so a single output file is safe."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def preview(df: DataFrame, keys: Sequence[str] | None = None, n: int = 20) -> DataFrame:
    """K5: first ``n`` rows in a stated order (all columns when ``keys`` is
    None). Planned as TakeOrderedAndProject: each task keeps its own top n,
    only n rows per task reach the final merge."""
    order = list(keys) if keys else list(df.columns)
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)


def sample_rows(df: DataFrame, n: int = 20) -> DataFrame:
    """K5 for profile samples: any ``n`` rows, as a printed sample shows.
    ``take`` reads one split first and goes on only while rows are missing,
    so a sample of a 100 TB table runs a few tasks; the ``n`` rows come to the
    driver here. Use ``preview`` when the rows must be the same on every
    run."""
    return df.sparkSession.createDataFrame(df.take(n), df.schema)
