"""Session helpers: one place for the settings every job in the library assumes.

* UTC session time zone (window starts are printed in UTC; NTZ columns are cast
  through it).
* AQE on, with partition coalescing and skew-join splitting, so shuffle sizes are
  re-planned at runtime instead of hand-tuned per query.
* A shared scratch folder for lineage cuts, stream checkpoints and round-trip sink
  writes. On a cluster that is ``spark.checkpoint.dir`` (a shared file system); a
  private folder is made only when nothing is configured, as in tests.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "flumen",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or return) a session with the library's defaults.

    ``shuffle_partitions`` should be sized so one shuffle partition is ~128-256 MB
    at the target scale; AQE coalesces small ones at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextlib.contextmanager
def state_store(spark: SparkSession, partitions: int | None = None):
    """The library's state store for queries that are started within, and the number of
    their state partitions, if given: a query takes over the session's settings as it
    starts. The session's own settings come back."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER}
    if partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    own = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in own.items():
            spark.conf.set(k, v)


def ensure_utc(spark: SparkSession) -> None:
    """All time arithmetic in the library is UTC (the reference prints UTC)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset (local
    tests) is a private temporary folder created; any other master without the setting
    is an error, as executors do not see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="flumen-scratch-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique sub-folder of the shared scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df, label: str, partition_by: str | None = None):
    """Write ``df`` once to the shared scratch folder and read it back.

    For tables that are used more than once and must be the same each time (rows
    with the bucket that one sampling gave them): their input is scanned once, and
    the lineage is cut at a reliable, shared copy."""
    path = scratch_path(df.sparkSession, label)
    out = df.write.mode("overwrite")
    (out.partitionBy(partition_by) if partition_by else out).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)     # also of a table without rows
