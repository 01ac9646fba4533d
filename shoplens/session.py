"""Session construction and the shared folder for checkpoints and snapshots."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = "local[8]", app: str = "shoplens",
                  shuffle_partitions: int | None = None,
                  driver_memory: str | None = None,
                  partition_bytes: str = "128m",
                  state_store: str | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with AQE on (runtime coalescing, skew splitting, broadcast
    conversion from measured sizes) and a UTC session time zone.

    ``partition_bytes`` is both the scan split size and AQE's target size for
    shuffle partitions, so a task's input stays far below executor memory at any
    scale. On a cluster (``master=None`` keeps the submitted master) set
    ``shuffle_partitions`` high, e.g. a few times the total cores: it is the upper
    bound AQE coalesces down from, to partitions of about ``partition_bytes``
    (``parallelismFirst`` off, so a busy cluster gets no flood of tiny tasks).
    Local runs default to one shuffle partition per core and keep them all busy
    on small inputs (parallelism first, 128 KB minimum partition).

    ``state_store="rocksdb"`` keeps streaming state in RocksDB (off the JVM heap,
    incremental checkpoints): the choice for large running totals on a cluster.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", partition_bytes)
         .config("spark.sql.files.maxPartitionBytes", partition_bytes)
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC"))
    local = bool(master) and master.startswith("local")
    b = (b.config("spark.sql.adaptive.coalescePartitions.parallelismFirst", str(local).lower())
         .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k" if local else "1m"))
    if shuffle_partitions is None and local:
        n = master[master.find("[") + 1:-1] if "[" in master else "1"
        shuffle_partitions = os.cpu_count() if n == "*" else int(n)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    if state_store == "rocksdb":
        b = b.config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset *and* Spark runs in local mode (tests) is a private
    temporary folder created and registered; a cluster without the setting is an
    error, because a machine-local folder is not visible to other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    root = tempfile.mkdtemp(prefix="shoplens-cp-")
    spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def run_root(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    return f"{checkpoint_root(spark)}/shoplens/run-{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared checkpoint folder. ``unique`` gives a new path below this
    application's folder, which ``remove_run_folder`` deletes."""
    if unique:
        return "/".join([run_root(spark), *parts, uuid.uuid4().hex])
    return "/".join([checkpoint_root(spark), "shoplens", *parts])


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    return fs.exists(p)


def remove_run_folder(spark: SparkSession) -> None:
    """Delete what this application wrote to unique paths; results that still read
    them must have been used."""
    p, fs = _hadoop(spark, run_root(spark))
    fs.delete(p, True)
