"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonehour.session import scratch_path

SMALL_BYTES = 8 << 20  # measured bound of a broadcast side
SALTS = 16  # tasks that share a key beyond it


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back: later
    readers see one fixed copy of the rows (ids drawn before the write stay
    as they are) and a lost executor recomputes from these files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def joined_small(rows: DataFrame, small: DataFrame, key: str, salt_by: str) -> DataFrame:
    """``rows`` with the columns of ``small``, a stored table with one row per
    value of ``key`` (null is a value).

    Its bytes are measured: up to SMALL_BYTES it is broadcast, beyond that its
    rows are dealt to SALTS tasks each, and the rows of a hot key spread over
    them by a hash of ``salt_by``.
    """
    width = F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) + 16 * len(small.columns)
    size = small.agg(F.sum(width.cast("long"))).first()[0] or 0
    side = small.withColumnRenamed(key, "_key")
    if size <= SMALL_BYTES:
        return rows.join(F.broadcast(side), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    side = side.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(SALTS)).cast("int"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_salt") == F.col("_copy"))
    return salted.join(side, same, "left").drop("_key", "_salt", "_copy")


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % divisor, F.lit(0))


def text_bytes(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a string column's rows, null as None."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for x in column.cast(kind):
        yield x.as_py()
