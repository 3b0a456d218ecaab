"""Session settings and shared working space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: Settings a cluster session should carry.  They are recommendations, never forced on a running session.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def local_session(cores: int | str = "*", app: str = "tidemark", **conf: str) -> SparkSession:
    """A local session with the recommended settings, for tests and benchmarks.

    ``spark.checkpoint.dir``, where intermediate results go, is a temporary folder unless ``conf`` names one.
    """
    parallel = "8" if cores == "*" else str(cores)
    conf.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", parallel)
    )
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Executors can be lost at any time, so intermediate results must live where every node can read them.  Only a
    local session, where driver and executors are one process, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder every node can reach")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


#: Folders staged within the innermost ``cleaned_up`` block.
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def cleaned_up(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside when the block ends, failed or not.  For work that returns no frame."""
    token = _STAGED.set([])
    try:
        yield
    finally:
        staged = _STAGED.get()
        _STAGED.reset(token)
        for path in staged:
            remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Files:
    """Small files and folders on whatever store a path names."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._path = spark, spark._jvm.org.apache.hadoop.fs.Path
        self._store = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._store.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        """What a folder holds."""
        return [f.getPath().getName() for f in self._store.listStatus(self._path(folder))]

    def make(self, folder: str) -> None:
        self._store.mkdirs(self._path(folder))

    def write(self, path: str, text: str) -> None:
        """A file that is there whole or not at all."""
        draft = self._path(f"{path}.draft")
        out = self._store.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self._store.rename(draft, self._path(path)):
            raise OSError(f"can't write {path}")

    def read(self, path: str) -> str:
        row = self._spark.read.text(path, wholetext=True).first()
        return row[0] if row else ""

    def move(self, path: str, to: str) -> None:
        if not self._store.rename(self._path(path), self._path(to)):
            raise OSError(f"can't move {path} to {to}")

    def delete(self, path: str) -> None:
        self._store.delete(self._path(path), True)


@dataclass(frozen=True)
class Staged:
    """A result written once, so several statements can read it without computing it again."""

    frame: DataFrame
    path: str


def stage(df: DataFrame, label: str = "stage", partition_by: Sequence[str] = ()) -> Staged:
    """Write ``df`` below the shared folder and read it back.  With ``partition_by``, parts can be read alone.

    This cuts the lineage durably: losing an executor costs a re-read of the files, not a recomputation, and the
    target table the batch was derived from may be replaced meanwhile.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if (open_ := _STAGED.get()) is not None:
        open_.append(path)
    (df.hint("rebalance", *partition_by) if partition_by else df).write.parquet(path, partitionBy=list(partition_by))
    return Staged(spark.read.schema(df.schema).parquet(path), path)
