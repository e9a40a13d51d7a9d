"""S1 over files whose schemas drift: a column that is whole numbers in one
month and decimals in the next, or missing altogether."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOOTER_THREADS = 8


def parquet_files(spark: SparkSession, path: str) -> list[str]:
    """The data files at or below ``path``, a file, folder or glob; hidden
    ones (``_SUCCESS``, ``.crc``) are left out."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for match in fs.globStatus(hadoop) or []:
        below = fs.listFiles(match.getPath(), True)
        while below.hasNext():
            f = below.next().getPath()
            if not f.getName().startswith(("_", ".")):
                found.append(f.toString())
    return sorted(found)


def footer_schemas(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """Files by the schema in their footer. One footer per file is read, by a
    few threads of the driver; no rows and no Spark job."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    parquet = jvm.org.apache.parquet.hadoop

    def schema(file: str) -> str:
        source = parquet.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf)
        reader = parquet.ParquetFileReader.open(source)
        try:
            return reader.getFooter().getFileMetaData().getSchema().toString()
        finally:
            reader.close()

    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        for file, text in zip(files, pool.map(schema, files)):
            groups.setdefault(text, []).append(file)
    return groups


def as_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The columns of ``types`` with these types. A missing one is null, and
    so is a value that its type cannot hold. A column that has its type
    already is left as it is, so that filters on it reach the scan."""
    have = {c.lower(): (c, kind) for c, kind in df.dtypes}
    out = []
    for name, kind in types.items():
        column, now = have.get(name.lower(), (None, None))
        value = F.lit(None) if column is None else F.col(f"`{column}`")
        out.append((value.cast(kind) if column is None else value if now == kind else value.try_cast(kind)).alias(name))
    return df.select(*out)


def read_drifting(spark: SparkSession, path: str, types: Mapping[str, str]) -> DataFrame:
    """The columns of ``types`` of all parquet files at ``path``, whatever
    their schemas: files of one footer schema are one scan, cast as in
    ``as_columns``, and the scans are united. Columns that ``types`` lacks are
    not read. No file at all is an error."""
    files = parquet_files(spark, path)
    if not files:
        raise ValueError(f"no parquet files at {path}")
    out = None
    for group in footer_schemas(spark, files).values():
        part = as_columns(spark.read.parquet(*group), types)
        out = part if out is None else out.unionByName(part)
    return out
