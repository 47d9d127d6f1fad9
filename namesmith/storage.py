"""Tables written on the way: they cut lineage and outlive lost executors."""

from __future__ import annotations

import logging
import os
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where the repository lies at the same path (else: --py-files)."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; on one machine a temporary folder where none is set, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="namesmith-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write as Parquet into the shared folder and read it back."""
    return _written(df, f"{shared_folder(df.sparkSession)}/namesmith/{name}-{uuid.uuid4().hex}")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _hadoop(spark, path)
    return system.exists(target)


def remove(spark: SparkSession, folder: str, keep: str = "") -> None:
    """Removes a folder's entries but the one to keep."""
    system, target = _hadoop(spark, folder)
    if system.exists(target):
        for entry in system.listStatus(target):
            if entry.getPath().getName() != keep:
                system.delete(entry.getPath(), True)


class Stages:
    """Named tables of one run in a folder: a run that finds a finished one reads it, another computes and writes it.

    A half-written table has no ``_SUCCESS`` and is written anew. ``version`` tells runs apart whose inputs or rules differ:
    tables of another version aren't read. Without a folder every table is written under a new name.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, version: str = ""):
        self.spark, self.version = spark, version
        self.folder = folder and f"{folder.rstrip('/')}/{version or 'all'}"
        self.reused: list[str] = []
        #: Figures of each stage of this run that was computed: what its rows added up to while they were written.
        self.figures: dict[str, dict] = {}

    def __call__(self, name: str, make, **figures: Column) -> DataFrame:
        """The table ``name``; ``make()`` gives its rows if they aren't there yet. ``figures``: aggregates beside their number."""
        if not self.folder:
            return self._observed(name, make, figures, lambda df: durable(df, name))
        path = f"{self.folder}/{name}"
        system, done = _hadoop(self.spark, f"{path}/_SUCCESS")
        if system.exists(done):
            self.reused.append(name)
            return self.spark.read.parquet(path)
        system.delete(done.getParent(), True)
        return self._observed(name, make, figures, lambda df: _written(df, path))

    def _observed(self, name: str, make, figures: dict[str, Column], write) -> DataFrame:
        seen = Observation(name)
        with Phase(name) as phase:
            out = write(make().observe(seen, F.count(F.lit(1)).alias("filas"), *(c.alias(k) for k, c in figures.items())))
        self.figures[name] = {**seen.get, "segundos": round(phase.seconds, 3)}
        Phase.log.info("%s: %s", name, self.figures[name])
        return out


class Phase:
    """Times a phase and logs its begin and end, and a failure as such."""

    log = logging.getLogger("namesmith")

    def __init__(self, name: str):
        self.name, self.seconds = name, None

    def __enter__(self) -> Phase:
        self.began = time.monotonic()
        self.log.info("begin %s", self.name)
        return self

    def __exit__(self, kind, *_) -> None:
        self.seconds = time.monotonic() - self.began
        self.log.info("%s %s (%.1f s)", "end" if kind is None else "FAILED", self.name, self.seconds)
