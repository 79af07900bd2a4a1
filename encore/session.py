"""Session construction and the shared checkpoint folder.

Operators never build a session themselves; they take the one they are
given. ``local_session`` exists for tests, ``bench.py`` and scripts.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | None = None, app: str = "encore") -> SparkSession:
    """A ``local[n]`` session with the settings the test-suite and bench use.

    AQE stays on so shuffles are coalesced and skewed join partitions are
    split at run time; the UI stays off (no server is started).
    """
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.default.parallelism", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ENCORE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_settings(spark: SparkSession, input_bytes: int, partition_bytes: int = 128 << 20) -> int:
    """Size shuffles for an input of ``input_bytes`` and let AQE refine them.

    Starts with one shuffle partition per ``partition_bytes`` of input (at
    least two per core), which AQE then coalesces toward the same advisory
    size; skewed join partitions are split. Returns the partition count.
    """
    cores = spark.sparkContext.defaultParallelism
    n = max(2 * cores, -(-int(input_bytes) // partition_bytes))
    for key, value in (
        ("spark.sql.adaptive.enabled", "true"),
        ("spark.sql.adaptive.coalescePartitions.enabled", "true"),
        ("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes)),
        ("spark.sql.adaptive.skewJoin.enabled", "true"),
        ("spark.sql.files.maxPartitionBytes", str(partition_bytes)),
        ("spark.sql.shuffle.partitions", str(n)),
    ):
        spark.conf.set(key, value)
    return n


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    On a cluster the folder must be the shared one named by
    ``spark.checkpoint.dir``; a machine-local temporary folder is only
    chosen for a local master (tests), never on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so checkpointed stages survive executor loss"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="encore-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables under the shared checkpoint root."""
    import uuid

    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/encore-tables/{name}-{uuid.uuid4().hex[:12]}"


#: Spark deletes a query's shuffle files when the query ends (else when the driver's garbage is collected).
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run in here delete their shuffle files when they end. For writes: what is
    written is read back, so the files are not needed again."""
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def drop_tables(tables: Iterable[DataFrame], prefix: str) -> None:
    """Delete the intermediate tables that ``tables`` read whose names begin with
    ``prefix``; nothing outside the checkpoint folder's tables is touched."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        for folder in sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}):
            if f"/encore-tables/{prefix}" in folder:
                path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
                path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> bool:
    """Delete the intermediate tables written under the checkpoint folder.

    Range-partitioned key tables, materialised interactions and drift counts
    live in ``<checkpoint dir>/encore-tables``; call this when the job that
    needed them is done.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/") + "/encore-tables"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(path)) and bool(fs.delete(path, True))
