"""Vector columns as matrices, and bounded samples of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(embeddings: DataFrame, key: str, vector: str, nonzero: bool) -> DataFrame:
    """``(vec_id, embedding)`` without rows whose vector is null or holds null or non-finite components (or is zero)."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = embeddings.select(F.col(key).cast("long").alias("vec_id"), v.alias("embedding")).where("embedding is not null and size(embedding) > 0")
    # null, NaN and infinite components all fail the comparison
    rows = rows.where(F.forall("embedding", lambda x: F.coalesce((x > F.lit(float("-inf"))) & (x < F.lit(float("inf"))), F.lit(False))))
    return rows.where(F.exists("embedding", lambda x: x != 0)) if nonzero else rows


def matrix(column) -> np.ndarray:
    """A list column whose rows have one length, as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(n, -1) if n else np.zeros((0, 0))


def by_dimension(rows: DataFrame, search, schema: str) -> DataFrame:
    """Union of ``search(rows of one dimension, that dimension)``: vectors of different dimensions aren't compared."""
    out = rows.sparkSession.createDataFrame([], schema)
    for (d,) in sorted(rows.select(F.size("embedding")).distinct().collect()):  # one number for each dimension that occurs
        out = out.union(search(rows.where(F.size("embedding") == d), d))
    return out


def sample(rows: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of at most ``limit`` rows of one dimension, those of least hash: a uniform sample."""
    got = rows.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id").limit(limit).toPandas()
    if not len(got):
        return np.zeros(0, np.int64), np.zeros((0, 0))
    return got["vec_id"].to_numpy(), np.stack([np.asarray(v, float) for v in got["embedding"]])


def top(scores: DataFrame, k: int, *then) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k best of ``(query_id, q, vec_id, score)``; q tells repeated queries apart.

    ``then``: an order among equal scores that comes before vec_id.
    """
    from pyspark.sql import Window

    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), *then, "vec_id", "copy")
    ranked = scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
