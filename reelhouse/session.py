"""Session construction and shared-storage helpers.

Everything here is plain Spark configuration.  The settings that matter at
scale are the AQE group: runtime broadcast decisions are made on measured
shuffle sizes (so a dimension is only broadcast once its size is known to be
under ``spark.sql.autoBroadcastJoinThreshold``), small shuffle partitions are
coalesced, and skewed sort-merge join partitions are split.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession

T = TypeVar("T")

# Settings applied to every session we build.  A cluster deployment passes its
# own master / memory / partition counts; these are the semantic ones.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Streaming state, where a caller keeps some, goes to RocksDB with changelog
    # checkpoints rather than on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # No empty micro-batches just to evict de-duplication state; the next
    # batch with data evicts it.  (No operator here emits on watermark alone.)
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "reelhouse",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    ``master`` and ``shuffle_partitions`` are left to the cluster when None.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    from .functions.sql import register_sql_functions
    register_sql_functions(spark)       # age_group(), engagement_level(), engagement_score()
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL-level options that can change on a live session."""
    for k in (
        "spark.sql.session.timeZone",
        "spark.sql.ansi.enabled",
        "spark.sql.adaptive.enabled",
        "spark.sql.adaptive.skewJoin.enabled",
        "spark.sql.adaptive.forceOptimizeSkewedJoin",
    ):
        try:
            spark.conf.set(k, BASE_CONF[k])
        except Exception:  # pragma: no cover - immutable on some deployments
            pass


def run_concurrently(jobs: dict[str, Callable[[], T]]) -> dict[str, T]:
    """Submit independent Spark jobs (e.g. one write per table) at the same
    time; the cluster scheduler interleaves their tasks, so one job's
    stragglers do not leave the others' executors idle."""
    if len(jobs) <= 1:
        return {k: f() for k, f in jobs.items()}
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {k: pool.submit(f) for k, f in jobs.items()}
        return {k: fut.result() for k, fut in futures.items()}


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder jobs may write intermediate tables to.

    Reads the cluster's ``spark.checkpoint.dir`` (or the context's checkpoint
    dir).  Only when neither is set and the master is local (unit tests) is a
    folder made; on a cluster each executor would write to its own disk.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="reelhouse-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh, unique sub-folder of the shared folder for one run."""
    return f"{shared_dir(spark)}/reelhouse/{label}-{uuid.uuid4().hex[:12]}"
