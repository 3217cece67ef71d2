"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings a cluster run should carry. Broadcasts stay behind Spark's own size
# check (autoBroadcastJoinThreshold); hot join keys are split by AQE.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Call sites for error messages cost several driver calls per expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


_scratch: set[str] = set()


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("badgeflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BADGEFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names storage every executor reaches, and a cluster must
    set it. Where all threads share one machine, a temporary folder does instead. The
    application's scratch is deleted when it ends; what is to last is kept elsewhere.
    """
    root = f"{shared_dir(spark)}/badgeflow/{spark.sparkContext.applicationId}"
    if root not in _scratch:
        store, name = file_system(spark, root)
        store.mkdirs(name)
        store.deleteOnExit(name)
        _scratch.add(root)
    return f"{root}/{label}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, as ``--py-files`` does.

    Python workers import it by name; without this, or an installed package, they would
    only find it where their working folder happens to be the repository's. Where all
    threads share one machine there is nothing to send.
    """
    context = spark.sparkContext
    if re.match(r"local(\[|$)", context.master) or context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    made = os.path.join(tempfile.mkdtemp(prefix="badgeflow-"), "badgeflow.zip")
    with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, files in os.walk(package):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(made)
    _shipped.add(context.applicationId)


def file_system(spark: SparkSession, path: str):
    """The store that holds a path, through Spark's own client, and the path's name there."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), name


def shared_dir(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(
                f"set spark.checkpoint.dir to storage all executors of {master} reach:"
                " a folder of this machine would not do"
            )
        shared = tempfile.mkdtemp(prefix="badgeflow-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")
