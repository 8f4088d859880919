"""Spark session construction and the shared scratch folder.

Nothing here hard-codes endpoints or credentials: object-store and JDBC
settings come from the cluster's own configuration.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job wants.
#
# Broadcast policy: before a query runs, Spark only knows compressed file
# sizes, which understate a table's in-memory size several times over, so
# the static threshold admits only tiny tables (nation, region). Everything
# else is broadcast only when AQE has *measured* the side at run time (shuffle
# statistics) and found it under the adaptive threshold; above it the join
# stays a sort-merge join, with skewed partitions split by AQE.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app_name: str = "cargolens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with AQE on and UTC session time.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset so the submit-time configuration applies.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        if master.startswith("local"):
            # One machine: listing folders from the driver beats launching a
            # listing job. Clusters keep Spark's parallel listing.
            builder = builder.config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    checkpoint_root(spark)
    return spark


def configured_checkpoint_dir(spark: SparkSession) -> str | None:
    """``spark.checkpoint.dir`` of the session or of its submit-time configuration."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        except AttributeError:  # Spark Connect has no SparkContext
            return None
    return root


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    The cluster names a folder every executor can reach; we only read it.
    Without one, a single-machine session (``local``, ``local[n]``) gets a
    temporary folder that goes when the process ends; any other master fails
    here, since its executors would each write to a disk of their own.
    """
    root = configured_checkpoint_dir(spark)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(
                f"master {master or 'unknown'}: set spark.checkpoint.dir to a folder that all executors share"
            )
        root = tempfile.mkdtemp(prefix="cargolens-checkpoints-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/cargolens/{spark.conf.get('spark.app.id', 'session')}"


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = f"{_scratch_root(spark)}/{uuid.uuid4().hex}"
    return "/".join([base, *parts]) if parts else base


def remove_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables; DataFrames that read them end here."""
    delete_path(spark, _scratch_root(spark))


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a Hadoop path, for any store Spark can reach."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; what was at ``to`` is replaced."""
    fs, source = _hadoop(spark, path)
    _, target = _hadoop(spark, to)
    fs.delete(target, True)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"could not move {path} to {to}")


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: under another name first, then renamed, so a
    reader never meets half of it."""
    fs, target = _hadoop(spark, path)
    _, part = _hadoop(spark, f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _hadoop(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a Hadoop glob (folder names only: no file is opened)."""
    fs, target = _hadoop(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(target) or [])


def list_folders(spark: SparkSession, pattern: str) -> list[tuple[str, str]]:
    """(path, change time) of the paths that match a Hadoop glob."""
    fs, target = _hadoop(spark, pattern)
    found = fs.globStatus(target) or []
    return sorted((s.getPath().toString(), str(s.getModificationTime())) for s in found)


#: Folders that a task writes side by side; rows of further folders are sorted first.
OPEN_FOLDERS = 8


@contextmanager
def open_folders(spark: SparkSession, most: int = OPEN_FOLDERS):
    """Inside, a write in folders keeps up to ``most`` files of a task open,
    instead of sorting all its rows by folder: the sort of a landing's wide
    rows, which all go to one or two folders, spills once a task outgrows its
    memory. Tasks with more folders sort the rest."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, "0")
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def local_os_path(path: str) -> str:
    """Strip a ``file:`` scheme for os-level inspection in tests."""
    return path[len("file:"):] if path.startswith("file:") else path


def parallelism(spark: SparkSession) -> int:
    """Task slots to spread a small write over (shuffle partitions where the
    SparkContext is not reachable, as on Spark Connect)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except AttributeError:  # Spark Connect has no SparkContext
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make DataFrame.checkpoint() usable: point the SparkContext at the
    shared checkpoint folder when it has none yet."""
    root = checkpoint_root(spark)
    try:
        sc = spark.sparkContext
    except AttributeError:  # Spark Connect manages this itself
        return root
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root
