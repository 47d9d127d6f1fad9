"""What the operators of this subpackage share: durable intermediate tables, components of a graph, packaging."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Rows and bytes of an Arrow batch: texts are long, so the usual 10000 of them would be tens of MB in each of several copies.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000, "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where the repository lies at the same path (else: --py-files).

    Lowers the session's bounds on Arrow batches to ``BATCH`` where they are larger: results are lazy, so they can't be put
    back here.
    """
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    for name, most in BATCH.items():
        held = int(str(spark.conf.get(name)).rstrip("bB"))
        if held > most or held <= 0:
            spark.conf.set(name, str(most))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, spark.checkpoint.dir; on one machine a temporary one where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        folder = context.getCheckpointDir()
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="namesmith-"))
            folder = context.getCheckpointDir()
    return folder.rstrip("/")


def release() -> None:
    """Give freed memory of this process back to the system: after a fit the driver goes on for long."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return a reader of it: lineage is cut, no executor owns it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/namesmith/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove written tables that nothing will read again."""
    for df in tables:
        hadoop = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def filter_batches(df: DataFrame, mask) -> DataFrame:
    """Rows of ``df`` for which ``mask(Arrow batch)``, an array of booleans, is true; all columns pass unchanged."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(mask(batch)))

    return ship(df.sparkSession) and df.mapInArrow(run, df.schema)


def holds_out(column: str, modulus: int, remainder: int):
    """Whether crc32 of a key's text leaves this remainder; a null key doesn't."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus == remainder, F.lit(False))


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "components") -> DataFrame:
    """``(node, root)`` of all nodes of an undirected graph; root is one node of the component.

    Each round renames every node to the neighbour (or itself) of least hash, with another hash every time, and maps
    the edges along, so even a long path shrinks by a share of itself; the renamings are then composed. All state lies
    in written tables.
    """
    edges = durable(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), name)
    steps = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        place = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(steps))).alias("h"), F.col(c).alias("n"))
        to = durable(both.groupBy(F.col("a").alias("node")).agg(F.min(place("b")).alias("m")).select("node", F.least(place("node"), "m")["n"].alias("to")), name)
        steps.append(to)
        x, y = to.select(F.col("node").alias("a"), F.col("to").alias("x")), to.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = durable(edges.join(x, "a").join(y, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), name)
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = steps[0].select("node", F.col("to").alias("root"))
    for to in steps[1:]:
        later = to.select(F.col("node").alias("root"), F.col("to").alias("next"))
        out = out.join(later, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return durable(out, name)
