"""SparkSession helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library's semantics depend on (not tuning knobs).
REQUIRED_CONF = {
    # Timestamps are naive wall-clock values; formatting must not shift them.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce tiny partitions, split skewed join partitions,
    # turn a shuffle join into a broadcast join only when the measured side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key of a join even when that costs one more shuffle after the
    # join (rows LEFT JOIN per-key aggregate, then a keyed aggregation): without
    # it AQE leaves a key holding a third of the rows in one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Batches between the JVM and Python are bounded by rows and by bytes (texts may be long), since both sides hold
    # a few of them per task.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def build_session(master: str | None = None, app: str = "martlake",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the library's required settings.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(REQUIRED_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to an existing session (e.g. the driver's)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object-store) folder there; it is used as is.
    Only in local mode, when it is unset (tests), a private scratch folder is
    created; on a cluster an unset folder is an error, never a machine-local one.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS or object "
                               "store) for checkpoints and intermediate tables")
        d = tempfile.mkdtemp(prefix="martlake-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


SCRATCH = "martlake-scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), SCRATCH, name)


def purge_scratch(spark: SparkSession, older_than_hours: float = 24.0) -> int:
    """Delete intermediate tables that were made longer ago than that (by the store's clock), of this and of ended sessions; the
    number deleted. A table is read lazily, so nothing is deleted by the job that made it: choose an age beyond any running job."""
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(ensure_checkpoint_dir(spark), SCRATCH))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return 0
    probe = spark._jvm.org.apache.hadoop.fs.Path(path, f".clock-{os.getpid()}")
    fs.create(probe, True).close()
    now = fs.getFileStatus(probe).getModificationTime()
    fs.delete(probe, False)
    old = [x.getPath() for x in fs.listStatus(path) if x.getModificationTime() < now - older_than_hours * 3_600_000]
    return sum(bool(fs.delete(p, True)) for p in old)
