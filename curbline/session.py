"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_root: str | None = None


def build_session(app: str = "curbline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library relies on; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # State grows with zones x open windows; keep it off the heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return pin_utc(builder.getOrCreate())


def shuffle_settings(shuffled_bytes: int, target_bytes: int = 200 << 20, least: int = 200,
                     most: int = 40_000) -> dict[str, str]:
    """Initial number of shuffle partitions for a job that shuffles about ``shuffled_bytes``.

    Adaptive execution merges partitions that turn out small but never makes more, except to split
    skew. Above ``most`` the bookkeeping of the driver costs more than larger, spilling partitions.
    A stream keeps the number it had when its checkpoint was made.
    """
    parts = min(max(-(-shuffled_bytes // target_bytes), least), most)
    return {"spark.sql.shuffle.partitions": str(parts),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes)}


def pin_utc(spark: SparkSession) -> SparkSession:
    """Trip times are naive UTC readings, so every session that touches them must read UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder all executors can reach.

    A cluster names its shared folder in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder of the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = _local_scratch_root(spark)
    return f"{root.rstrip('/')}/curbline/{label}-{uuid.uuid4().hex}"


def _local_scratch_root(spark: SparkSession) -> str:
    global _local_root
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="curbline-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and the path in it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(conf), place


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, place = _file_system(spark, path)
    return fs.exists(place)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, place = _file_system(spark, path)
    fs.mkdirs(place)


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and time of the files at ``path``, a file or a folder."""
    fs, place = _file_system(spark, path)
    if not fs.exists(place):
        return []
    found = [fs.getFileStatus(place)] if fs.getFileStatus(place).isFile() else [s for s in fs.listStatus(place) if s.isFile()]
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found)


def remove_tree(spark: SparkSession, path: str) -> None:
    fs, place = _file_system(spark, path)
    fs.delete(place, True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a working folder made by ``scratch_dir``, with all it holds."""
    if "/curbline/" not in path and not (_local_root and path.startswith(_local_root)):
        raise ValueError(f"not a working folder: {path}")
    fs, place = _file_system(spark, path)
    fs.delete(place, True)
