"""Session settings the library relies on, and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package assumes.  UTC makes hour and day keys
# independent of the machine; ANSI makes a zero price sum an error instead of
# a silent NULL; AQE re-plans joins from measured shuffle sizes and splits
# skewed join partitions.  No join is broadcast from a planner size estimate:
# the library broadcasts explicitly behind a measured row count, and AQE may
# convert a join at run time from the measured size of a finished shuffle.
RECOMMENDED_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


# Settings for a large cluster (about 100 TB of trades), applied by the deployment,
# not by this package: many shuffle partitions that AQE coalesces at run time,
# 256 MB input splits, and run-time (measured) broadcast conversion kept small.
CLUSTER_CONF = {
    **RECOMMENDED_CONF,
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tradelens", extra: dict | None = None) -> SparkSession:
    """A session for tests, the bench and local runs (the UI stays off)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for key, value in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_recommended(spark: SparkSession) -> None:
    """Apply ``RECOMMENDED_CONF`` to a session built elsewhere: time zone and ANSI mode
    always; the join and AQE settings only where the session leaves them unset."""
    always = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")
    for key, value in RECOMMENDED_CONF.items():
        if key in always or spark.conf.getAll.get(key) is None:
            spark.conf.set(key, value)


def is_local(spark: SparkSession) -> bool:
    """One JVM (``local`` or ``local[...]``); ``local-cluster`` runs separate executors."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    On a cluster this is the folder the cluster names in ``spark.checkpoint.dir`` (or the
    context's checkpoint folder); without one this raises, since a machine-local folder
    would be invisible to the other machines.  In a single JVM (tests, local runs) a
    temporary folder is created and registered with the context.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tradelens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location (its URI is kept)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
