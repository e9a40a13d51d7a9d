"""Scans and read-side contracts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonehour.config import MSG_MISSING_COLUMNS
from zonehour.sources.drift import read_drifting


def read_trips(spark: SparkSession, path: str | list[str], types: Mapping[str, str] | None = None) -> DataFrame:
    """Raw trip parquet. Projection and filters applied later are pushed
    into this scan by Catalyst (``ReadSchema`` / ``PushedFilters``). With
    ``types`` (``dict(RAW_TRIP_TYPES)``) the files' schemas may differ; see
    ``drift.read_drifting``."""
    paths = [path] if isinstance(path, str) else list(path)
    if types is None:
        return spark.read.parquet(*paths)
    parts = [read_drifting(spark, p, types) for p in paths]
    return reduce(DataFrame.unionByName, parts)


def read_weather_lines(
    spark: SparkSession, path: str, min_partitions: int | None = None, recursive: bool = False
) -> DataFrame:
    """S2 + S4: weather text (gzip or plain, glob allowed) as ``value`` plus
    the ``source_path`` of the file each line came from. ``recursive`` reads
    every file below a folder (no partition columns are inferred).

    A gzip file is not splittable, so one file is one task. Hourly station
    files are small; pass ``min_partitions`` when a few large files would
    otherwise leave most executors idle (round-robin after a local sort, so a
    retried task sees the same rows).
    """
    reader = spark.read.option("recursiveFileLookup", "true") if recursive else spark.read
    lines = with_source_path(reader.text(path))
    if min_partitions:
        lines = lines.repartition(min_partitions)
    return lines


def stage_weather_lines(lines: DataFrame, path: str) -> DataFrame:
    """S2 in one pass: the lines and their source paths as splittable parquet
    of even parts at ``path``, read back. A gzip file is decompressed by one
    task, once; what follows (profiles, cleaning) reads the copy, in as many
    tasks as its size asks for. ``path`` is overwritten."""
    lines.select("value", "source_path").hint("rebalance").write.mode("overwrite").parquet(path)
    return lines.sparkSession.read.schema("value string, source_path string").parquet(path)


def with_source_path(df: DataFrame, name: str = "source_path") -> DataFrame:
    """File of origin from the hidden ``_metadata`` column of file sources."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """S3: a date-partitioned clean table. The partition column is discovered
    from directory names (typed as date), so filters on it prune directories."""
    return spark.read.option("basePath", path).parquet(path)


def require_columns(df: DataFrame, required: Iterable[str], name: str) -> DataFrame:
    """Fail at analysis time, naming every missing column. Runs no job."""
    have = set(df.columns)
    missing = [c for c in required if c not in have]
    if missing:
        raise ValueError(MSG_MISSING_COLUMNS.format(name=name, columns=", ".join(missing)))
    return df
