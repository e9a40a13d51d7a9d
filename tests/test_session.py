"""The shared scratch folder comes from the session; only a bare session
gets one of its own."""

import os
import subprocess
import sys
import tempfile
from pathlib import Path

import pytest

from zonehour.session import ensure_checkpoint_dir, scratch_path

ROOT = Path(__file__).resolve().parents[1]


def test_uses_the_configured_checkpoint_dir(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    got = ensure_checkpoint_dir(spark)
    if configured:
        assert configured.rstrip("/").split(":")[-1] in got
    assert scratch_path(spark, "x").startswith(got.rstrip("/") + "/zonehour-scratch-")


def test_bare_session_gets_its_own_folder():
    conf_dir = tempfile.mkdtemp(prefix="zonehour-noconf-")  # no spark-defaults.conf in it
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "from zonehour.session import ensure_checkpoint_dir\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "before = s.sparkContext.getCheckpointDir()\n"
        "print('BEFORE', before)\n"
        "print('AFTER', ensure_checkpoint_dir(s))\n"
        "s.stop()\n"
    ) % str(ROOT)
    env = dict(os.environ, SPARK_CONF_DIR=conf_dir)
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300).stdout
    lines = dict(line.split(" ", 1) for line in out.splitlines() if line.startswith(("BEFORE", "AFTER")))
    assert lines["BEFORE"] == "None"
    assert "zonehour-ckpt-" in lines["AFTER"]


def test_other_masters_need_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_cluster_conf_scales_with_cores():
    from zonehour.session import cluster_conf

    conf = cluster_conf(1000)
    assert conf["spark.sql.shuffle.partitions"] == "3000"
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert "spark.checkpoint.dir" not in conf  # taken from the cluster, never set here
