"""Session and shared-folder helpers.

Every job that materialises intermediate data writes it under the folder the
cluster names in ``spark.checkpoint.dir`` (a shared file system on a real
cluster).  Only when that setting is missing -- local tests -- do we pick a
fresh scratch folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "tickline",
              shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.python.filterPushdown.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings every query needs; safe on an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started:
    Spark's own file service hands them a zip of the sources (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tickline-pkg-"), "tickline-src.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, dirs, names in os.walk(root):
            dirs.sort()
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("tickline", os.path.relpath(full, root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``; set one only if unset."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tickline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def workspace(spark: SparkSession, name: str = "work") -> str:
    """A fresh, never reused folder under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    path = os.path.join(root.replace("file:", ""), "tickline", f"{name}-{uuid.uuid4().hex[:12]}")
    if "://" in root:
        path = root.rstrip("/") + f"/tickline/{name}-{uuid.uuid4().hex[:12]}"
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system that Spark knows is there."""
    if path[1:2] == ":":        # a drive letter, not a scheme
        return os.path.exists(path)
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hp))
