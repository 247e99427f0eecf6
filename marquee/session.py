"""Session defaults and the shared scratch location.

Nothing here is required by the operators: they only take DataFrames. The
builder is what tests, the bench and the scripts use.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # splits a hot key's partition on the fact side of a sort-merge left join
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: how tables are written, whatever the session's default codec is
TABLE_OPTIONS = {"compression": "zstd"}


def build_session(
    master: str = "local[*]",
    app_name: str = "marquee",
    shuffle_partitions: int = 8,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(
    largest_shuffle_bytes: int,
    input_bytes_per_task: int = 256 << 20,
    shuffle_bytes_per_task: int = 256 << 20,
    executor_cores: int | None = None,
) -> dict[str, str]:
    """Partition sizing for a run over large inputs.

    Scan splits of ``input_bytes_per_task`` and post-shuffle partitions of
    ``shuffle_bytes_per_task`` keep a task's working set well inside an
    executor's share of memory (sorts and hash tables spill beyond it). The
    initial shuffle partition count is sized for the largest shuffle of the
    run; AQE coalesces small shuffles down to the advisory size and splits
    skewed partitions of sort-merge joins.
    """
    partitions = max(200, -(-largest_shuffle_bytes // shuffle_bytes_per_task))
    conf = {
        "spark.sql.files.maxPartitionBytes": str(input_bytes_per_task),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_bytes_per_task),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * shuffle_bytes_per_task),
    }
    if executor_cores:
        conf["spark.executor.cores"] = str(executor_cores)
    return conf


@contextmanager
def open_writers(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Meanwhile a task that writes a table of so few partitions keeps a file of
    each open, and doesn't sort its rows by partition; rows of further
    partitions are sorted as usual. Bucketed tables are not concerned."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(partitions))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def drop_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of what has been written: Spark deletes them
    once the driver's garbage, which holds their plans, is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_root(spark: SparkSession) -> str:
    """Base folder for snapshots, landing files and stream checkpoints.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``;
    it is read from the session. Only a local master may go without: there
    driver and executors are one process, and a temporary folder is set.
    """
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # setCheckpointDir appends a per-context uuid folder; share its parent
        return os.path.dirname(current.rstrip("/"))
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
    local = tempfile.mkdtemp(prefix="marquee-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused folder under the shared root for one run."""
    return f"{shared_root(spark)}/marquee/{purpose}-{uuid.uuid4().hex[:12]}"
