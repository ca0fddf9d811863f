"""SparkSession helpers shared by plans, tests and the bench."""

from __future__ import annotations

import contextlib
import os
import tempfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "salescast") -> SparkSession:
    """Session tuned for this library: AQE on, UTC, Arrow, UI off."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Coalesced partitions may be small so tiny inputs still spread over
        # all cores (AQE targets total size / default parallelism).
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # Directory listing of day-partitioned tables runs as a Spark job; one
        # task per directory (default cap 10000) is pure scheduling overhead
        # for thousands of small day folders, so group directories per task.
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(max(16, shuffle_partitions * 4)))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", os.environ.get("SALESCAST_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Runtime SQL setting the library relies on: timestamps are parsed as UTC instants.
RUNTIME_CONF = {"spark.sql.session.timeZone": "UTC"}


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply RUNTIME_CONF to an existing session (e.g. one the caller built)."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is unset
    on a local master fall back to a fresh scratch folder. On a cluster without
    it this raises: executors would write to their own disks."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="salescast-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return conf_dir


@contextlib.contextmanager
def session_conf(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting inside; the caller's own comes back afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextlib.contextmanager
def session_confs(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Several session settings inside; the caller's own come back afterwards."""
    with contextlib.ExitStack() as held:
        for name, value in settings.items():
            held.enter_context(session_conf(spark, name, value))
        yield


def dynamic_overwrite(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Table inserts inside replace only the partitions they write."""
    return session_conf(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint dir (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
