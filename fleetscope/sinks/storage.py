"""Files and scratch tables on whatever file system a path names."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# a cluster must name a folder that all its executors share; a session that runs
# inside this one process has only its own working folder, and any path is shared
_LOCAL_FOLDER = "checkpoints"
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # since Spark 4.1


def shared_folder(spark: SparkSession, name: str = "fleetscope") -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: name a folder all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir", str(Path.cwd()))
        root = f"{warehouse.rstrip('/')}/{_LOCAL_FOLDER}"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, as Spark itself resolves them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system.makeQualified(found), system


def delete(spark: SparkSession, path: str) -> None:
    found, system = hadoop_path(spark, path)
    system.delete(found, True)


def exists(spark: SparkSession, path: str) -> bool:
    found, system = hadoop_path(spark, path)
    return system.exists(found)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, sorted; nothing if there is no such folder."""
    found, system = hadoop_path(spark, path)
    if not system.exists(found):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(found))


def age_seconds(spark: SparkSession, path: str) -> float:
    """How long ago the file or folder was changed, by the clock of this process."""
    found, system = hadoop_path(spark, path)
    return time.time() - system.getFileStatus(found).getModificationTime() / 1000


def rename(spark: SparkSession, source: str, target: str, over: bool = False) -> None:
    """One rename; a target that exists fails it, or with ``over`` (files only)
    gives way in the same step."""
    from_path, _ = hadoop_path(spark, source)
    to_path, _ = hadoop_path(spark, target)
    hadoop = spark._jvm.org.apache.hadoop
    files = hadoop.fs.FileContext.getFileContext(
        from_path.toUri(), spark._jsparkSession.sessionState().newHadoopConf()
    )
    kind = hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, int(over))
    if over:
        options[0] = kind.OVERWRITE
    files.rename(from_path, to_path, options)


def write_file(spark: SparkSession, path: str, lines: Iterable[str]) -> None:
    """A small text file. It appears whole, in the place of one that was there."""
    staged = f"{path}.{uuid.uuid4().hex}"
    found, system = hadoop_path(spark, staged)
    out = system.create(found)
    try:
        for line in lines:
            out.write(f"{line}\n".encode())
    finally:
        out.close()
    rename(spark, staged, path, over=True)


def read_file(spark: SparkSession, path: str) -> str | None:
    """A small text file's content, None where there is none."""
    found, system = hadoop_path(spark, path)
    if not system.exists(found):
        return None
    source = system.open(found)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def _beside(spark: SparkSession, path: str, kind: str) -> list[str]:
    """Folders next to ``path`` that a replacement of it has left, oldest first."""
    found, _ = hadoop_path(spark, path)
    parent, mark = found.getParent().toString(), f"{found.getName()}-{kind}-"
    left = [f"{parent}/{name}" for name in names(spark, parent) if name.startswith(mark)]
    return sorted(left, key=lambda folder: -age_seconds(spark, folder))


def aside(spark: SparkSession, path: str) -> str | None:
    """The whole table that a replacement, killed before its end, has put aside."""
    return None if exists(spark, path) else next(reversed(_beside(spark, path, "replaced")), None)


def recover(spark: SparkSession, path: str) -> None:
    """Undo a replacement that was killed between its two renames, and free what
    one that was killed after them has left."""
    old = aside(spark, path)
    if old is not None:
        rename(spark, old, path)
    for left in _beside(spark, path, "replaced"):
        delete(spark, left)


def replace(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder in the place of another one.

    The old folder is renamed aside, the new one renamed in, and only then is the
    old one deleted. If the second rename fails the old folder is put back; if
    this fails as well, or the process dies in between, both folders are whole
    and ``recover`` puts the old one back."""
    recover(spark, path)
    found, system = hadoop_path(spark, path)
    system.mkdirs(found.getParent())
    old = f"{found.toString()}-replaced-{uuid.uuid4().hex}"
    had = system.exists(found)
    if had:
        rename(spark, path, old)
    try:
        rename(spark, staged, path)
    except BaseException:
        if had:
            rename(spark, old, path)
        raise
    if had:
        delete(spark, old)
    spark.catalog.refreshByPath(path)


class Scratch:
    """Tables of one run, in a folder of their own.

    Written tables cut the lineage: what reads them survives lost executors
    without repeating the work before. ``drop`` frees what is no longer read."""

    def __init__(self, spark: SparkSession, name: str = "scratch") -> None:
        self.spark = spark
        self.folder = shared_folder(spark, name)
        self._written = 0

    def save(self, df: DataFrame, free: bool = False) -> DataFrame:
        """``free``: what this write has shuffled leaves the disk at its end."""
        self._written += 1
        path = f"{self.folder}/{self._written}"
        before = self.spark.conf.get(_FREE_SHUFFLES, "false")
        if free:
            self.spark.conf.set(_FREE_SHUFFLES, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            if free:
                self.spark.conf.set(_FREE_SHUFFLES, before)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved.scratch_path = path
        return saved

    def drop(self, *saved: DataFrame) -> None:
        for df in saved:
            delete(self.spark, df.scratch_path)
