"""Session helpers: recommended settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs are designed for. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
}


def cluster_conf(total_cores: int, split_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Settings for a spark-submit run on ``total_cores`` executor cores.

    The trip table is read in ``split_bytes`` splits and written without a
    shuffle; every shuffle in the chain carries partial aggregates, not
    trips. So the shuffle partition count only has to give every core work
    (3 per core); AQE coalesces what turns out small and splits a skewed
    partition. Lost executors are retried rather than failing the job, and
    their shuffle files are recomputed from lineage or the written tables.
    """
    return {
        **RECOMMENDED_CONF,
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(max(1, 3 * total_cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(split_bytes),
        "spark.task.maxFailures": "8",
        "spark.stage.maxConsecutiveAttempts": "8",
        "spark.excludeOnFailure.enabled": "true",
    }


_SCRATCH_ROOTS: set[str] = set()


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "zonehour", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster the session comes from spark-submit,
    with the settings of ``cluster_conf``."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Reads ``spark.checkpoint.dir`` / the context's checkpoint dir from the
    session. Where neither is set, a local session (``local[...]``) gets a
    folder under the system temp folder; any other master is an error, as its
    executors could not see such a folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="zonehour-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, in a folder of
    this application that is deleted when its JVM ends."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/zonehour-scratch-{spark.sparkContext.applicationId}"
    if root not in _SCRATCH_ROOTS:
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
        _SCRATCH_ROOTS.add(root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def file_identity(spark: SparkSession, path: str) -> tuple:
    """Name, length and modification time of the file ``path`` or of every
    file in it: equal as long as the input is not rewritten."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(folder)))
