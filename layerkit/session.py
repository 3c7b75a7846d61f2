"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_SCRATCH_PREFIX = "layerkit"


def build_session(master: str | None = None, app_name: str = "layerkit",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with the settings the library is tuned for.

    On a cluster call it without ``master``; the cluster manager supplies it.
    AQE is on so shuffle partitions are coalesced / skewed joins split at run time.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # broadcast only below a checked size; Catalyst/AQE compare plan statistics with it
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.schemaInference": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master is None or not master.startswith("local"):
        # on a shared cluster AQE sizes post-shuffle partitions by bytes (advisory size), not by
        # the core count: fewer, fuller tasks. Locally, parallelism first keeps all cores busy.
        conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root named by ``spark.checkpoint.dir``.

    On a cluster this is a shared file system path set by the operator. Only when it
    is unset (local tests) a private temporary folder is created and registered.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for cluster runs")
        root = tempfile.mkdtemp(prefix="layerkit-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared checkpoint root (never reused)."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/{_SCRATCH_PREFIX}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_area(spark: SparkSession, label: str) -> Iterator[str]:
    """A fresh scratch folder that is dropped at the end: for tables that nothing reads any more."""
    area = scratch_path(spark, label)
    try:
        yield area
    finally:
        drop_folder(spark, area)


# of long chains of writes: tables take less room, and the shuffle files of a statement go when it ends (else they stay
# until the driver happens to collect its garbage)
_SPARING = {"spark.sql.parquet.compression.codec": "zstd", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def sparing_disk(spark: SparkSession) -> Iterator[None]:
    """The statements within, and streams that start within, keep little on disk besides the tables they write."""
    before = {k: spark.conf.get(k, None) for k in _SPARING}
    for k, v in _SPARING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_marker(spark: SparkSession, path: str, text: str = "") -> None:
    """A small file beside a table (any file system); readers see it whole or not at all."""
    p, fs = _hadoop(spark, path + ".tmp")
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    move(spark, path + ".tmp", path)


def read_marker(spark: SparkSession, path: str) -> str:
    p, fs = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def newest_marker(spark: SparkSession, folder: str) -> int:
    """The largest number that names a marker in the folder (0: none)."""
    return max((int(n) for n in child_names(spark, folder) if n.isdigit()), default=0)


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder (none if there is no such folder)."""
    p, fs = _hadoop(spark, folder)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the target must not exist."""
    p, fs = _hadoop(spark, source)
    t, _ = _hadoop(spark, target)
    fs.mkdirs(t.getParent())
    if not fs.rename(p, t):
        raise OSError(f"cannot rename {source} to {target}")


def drop_folder(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop(spark, path)
    fs.delete(p, True)


def size_shuffle_partitions(spark: SparkSession, input_bytes: int, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Set the initial shuffle partition count from the input size (AQE then coalesces small
    partitions and splits skewed ones). At 100 TB and 256 MB per partition this is ~400k; the
    floor is twice the default parallelism so every core has work."""
    floor = 2 * spark.sparkContext.defaultParallelism
    n = max(floor, -(-int(input_bytes) // int(target_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n
