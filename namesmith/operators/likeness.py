"""Similarity join of short texts: all pairs of two columns whose indel ratio reaches a threshold, without comparing all.

Each distinct text is looked at once, whatever the number of records that hold it. The threshold bounds how many letters
two texts may add and drop, hence how many of a text's letter pairs can be lost: 2 for each letter dropped, 1 for each one
added. Of the first (lost + 1) letter pairs in a common order, here of hashes, then of places, at least one must stand in
both texts, its places no farther apart than letters were added or dropped. So an equi-join of those few letter pairs,
a bound on places and one on lengths leave the pairs to verify; nothing is lost. The vocabulary's side is small and is
broadcast where Spark finds it to be; otherwise both sides are shuffled by letter pair.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.similarity import indel_ratio, length_bound

TABLE = 64


def most_lost(n: int, threshold: float) -> int:
    """How many letter pairs a text of ``n`` letters can lose against one that it reaches ``threshold`` with."""
    lost = 0
    for m in range(-int(-n * threshold // (200 - threshold)), int(n * (200 - threshold) / threshold + 1e-9) + 1):
        changed = int((1 - threshold / 100) * (n + m) + 1e-9)
        changed -= (changed - n - m) % 2  # dropped and added letters account for the difference of lengths
        if changed >= abs(n - m):
            lost = max(lost, changed + (changed + n - m) // 2)
    return lost


def keys(df: DataFrame, text: str, threshold: float, short: int) -> DataFrame:
    """A row for each letter pair of the prefix: ``df``'s columns with ``gram`` and ``place``."""
    # Written as text: each expression costs a call to the JVM when it is built of columns.
    c = f"`{text}`"
    grams = f"array_sort(transform(sequence(1, greatest(length({c}) - 1, 1)), i -> struct(xxhash64(substr({c}, i, 2)) as h, i as place, substr({c}, i, 2) as gram)))"
    table = f"element_at(array({', '.join(str(most_lost(k, threshold) + 1) for k in range(TABLE + 1))}), least(length({c}), {TABLE}) + 1)"
    # Beyond the table: 2 for each letter that may change against the longest partner.
    beyond = f"cast(floor(length({c}) * {2 * (1 - threshold / 100) * (1 + (200 - threshold) / threshold)}d + 1e-9d) + 1 as int)"
    first = f"slice({grams}, 1, if(length({c}) <= {TABLE}, {table}, {beyond}))"
    # Texts with fewer letter pairs than that, and all that they could match, also meet by a key of their own.
    alone = "array(struct(0L as h, 0 as place, '' as gram))"
    made = F.expr(f"inline(if(length({c}) <= {short}, concat({first}, {alone}), {first}))")
    return df.select(*df.columns, made).drop("h")


@lru_cache
def shortest_indexed(threshold: float) -> int:
    """The greatest length that a text without enough letter pairs, or one that it could match, may have."""
    if threshold <= 80:
        raise ValueError("letter pairs tell nothing of texts whose ratio is 80 or less")
    void = [n for n in range(TABLE * 8) if n - 1 < most_lost(n, threshold) + 1]
    return int(max(void, default=0) * (200 - threshold) / threshold + 1e-9)


def candidates(texts: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    """Pairs to verify, each once: ``texts``' column text (distinct) with ``words``' columns, of which the first is the word."""
    short, word = shortest_indexed(threshold), words.columns[0]
    left = keys(texts.select("text"), "text", threshold, short)
    right = keys(words, word, threshold, short).withColumnRenamed("place", "_place")
    apart = (1 - threshold / 100) * (F.length("text") + F.length(word)) + 1e-9
    near = left.join(right, "gram").where(length_bound(F.col("text"), F.col(word), threshold) & (F.abs(F.col("place") - F.col("_place")) <= apart))
    return near.select("text", *words.columns).distinct()


def similar(texts: DataFrame, words: DataFrame, threshold: float, accept: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``(text, word..., ratio)``: all pairs that ``accept`` takes and whose ratio reaches ``threshold``; nulls match nothing.

    ``texts`` are distinct; repeated ones only cost time.
    """
    word = words.columns[0]
    pairs = candidates(texts.where("text is not null"), words.where(F.col(word).isNotNull()), threshold)
    if accept:
        pairs = pairs.where(accept(F.col("text"), F.col(word)))
    return pairs.withColumn("ratio", indel_ratio(F.col("text"), F.col(word))).where(F.col("ratio") >= threshold)


def best(texts: DataFrame, words: DataFrame, threshold: float, accept=None) -> DataFrame:
    """``(text, word)`` of texts that have one: the word of highest ratio, the first by ``rank`` of equals. ``words``: (word, rank)."""
    order = F.struct("ratio", -F.col("rank"))
    return similar(texts, words, threshold, accept).groupBy("text").agg(F.max_by("word", order).alias("word"))


def vocabulary(spark: SparkSession, words: list[str]) -> DataFrame:
    """``(word, rank)`` in the order given."""
    import pyarrow as pa

    return spark.createDataFrame(pa.table({"word": pa.array(words, pa.string()), "rank": pa.array(range(len(words)), pa.int32())}))
