"""Incremental loads: new names resolved against a master as they stream in.

An extension, in two forms. ``start`` cleans and keys each micro-batch with the rules alone and joins it with a master by
exact key. ``maintain`` keeps the whole resolution up to date, as a versioned table for each load: the names of a load that
bring a new key, or a better text for a known one, and what their blocks make of others, are decided again, and the
components that these touch are clustered again; all else is carried over. With the statistics that a full run would use
(document frequencies, generic tokens), the clusters after any number of loads are those of one run over all names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import SETTINGS
from ..operators import records, resolution
from ..operators.knowledge import Knowledge, default
from ..storage import durable, exists, remove, ship


def resolve(batch: DataFrame, master: DataFrame, generic: list[str], knowledge: Knowledge | None = None) -> DataFrame:
    """``(idx, nombre_original, clave, tipo, cluster)``; cluster is null without a match. ``master``: (clave, cluster)."""
    knowledge = knowledge or default()
    rows = records.keyed(records.first_pass(batch, knowledge), generic, knowledge)
    return rows.join(master.select("clave", "cluster"), "clave", "left").select("idx", "nombre_original", "clave", "tipo", "cluster")


def start(stream: DataFrame, master: DataFrame, generic: list[str], output: str, checkpoint: str, knowledge: Knowledge | None = None):
    """Starts a query that appends resolved rows to ``output``, each micro-batch in a folder of its own (replays overwrite it)."""
    ship(stream.sparkSession)

    def write(batch: DataFrame, number: int) -> None:
        resolve(batch, master, generic, knowledge).write.mode("overwrite").parquet(f"{output}/lote={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Statistics(NamedTuple):
    """What a load is measured by, from the last full run: token frequencies, generic tokens, and the cut for rare ones."""

    frequency: DataFrame
    generic: list[str]
    cut: int


STATE = {
    "nodes": "clave string, best struct<whole:int,len:int,limpio:string,nucleo:string>, first struct<idx:bigint,tokens:array<string>>, truncado boolean, n_registros bigint",
    "rare": "clave string, token string, df bigint, rank int",
    "signals": "signal string, clave string",
    "accepted": "a string, b string, score double",
    "members": "clave string, cluster string, component string",
    "drift": "carga bigint, registros bigint, empleadores bigint, claves_nuevas bigint, claves_mejoradas bigint, palabras bigint, palabras_desconocidas bigint, pares bigint, claves_reagrupadas bigint",
}


class Master:
    """The resolution after each load, as tables in ``folder/v=<load>/<name>``.

    Load n reads version n - 1 and writes version n, drift figures last. A load that was cut short leaves no such figures
    and is done again from the same version, so it gives the same tables. Versions before the last two are removed.
    """

    def __init__(self, spark: SparkSession, folder: str, statistics: Statistics, knowledge: Knowledge | None = None):
        self.spark, self.folder, self.statistics, self.knowledge = spark, folder.rstrip("/"), statistics, knowledge or default()

    def path(self, version: int, name: str) -> str:
        return f"{self.folder}/v={version}/{name}"

    def done(self, version: int) -> bool:
        return exists(self.spark, f"{self.path(version, 'drift')}/_SUCCESS")

    def read(self, name: str, version: int) -> DataFrame:
        if version < 0:
            return self.spark.createDataFrame([], STATE[name])
        return self.spark.read.schema(STATE[name]).parquet(self.path(version, name))

    def load(self, names: DataFrame, version: int) -> None:
        """Takes in a load of ``(idx, nombre_original)``; versions count from 0."""
        if self.done(version):
            return
        if version and not self.done(version - 1):
            raise ValueError(f"load {version} comes before load {version - 1} is done")
        old = {name: self.read(name, version - 1) for name in STATE}

        def write(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(self.path(version, name))
            return self.read(name, version)

        rows = durable(records.keyed(records.first_pass(names, self.knowledge), self.statistics.generic, self.knowledge), "load")
        keys = durable(self._keys(rows, old["nodes"]), "keys")
        given = keys.select("clave", "state.*")
        nodes = write(old["nodes"].join(keys.select("clave"), "clave", "left_anti").unionByName(given), "nodes")
        # Keys whose own text or tokens are others than before: all that is known of their pairs is void.
        fresh = keys.where("fresh").select("clave")
        own = durable(resolution.rare_tokens(given.join(fresh, "clave").select("clave", F.col("first.tokens").alias("tokens")), self.statistics.frequency), "rare")
        rare = write(old["rare"].join(fresh, "clave", "left_anti").unionByName(own), "rare")
        signals = write(old["signals"].join(fresh, "clave", "left_anti").unionByName(resolution.signals(own)), "signals")
        dirty = durable(fresh.union(self._flipped(old["signals"], signals, fresh)).distinct(), "dirty")
        decided = resolution.decide(self._candidates(signals, dirty), _plain(nodes), rare, self.statistics.cut)
        new = durable(decided.where("accepted").select("a", "b", "score"), "pairs")
        kept = old["accepted"]
        for end in ("a", "b"):
            kept = kept.join(dirty.select(F.col("clave").alias(end)), end, "left_anti")
        accepted = write(kept.select("a", "b", "score").unionByName(new), "accepted")
        scope = self._scope(old["members"], dirty, new)
        members = write(old["members"].join(scope, "clave", "left_anti").unionByName(self._clustered(accepted, nodes, scope)), "members")
        known = self.statistics.frequency.select("token")
        words = resolution.employers(rows).select(F.explode("tokens").alias("token"))
        figures = (
            rows.agg(F.count("*").alias("registros"), F.count_if(F.col("tipo").isin("EMPRESA", "PERSONA_NATURAL")).alias("empleadores")),
            keys.agg(F.count_if("new").alias("claves_nuevas"), F.count_if(F.col("fresh") & ~F.col("new")).alias("claves_mejoradas")),
            words.agg(F.count("*").alias("palabras")), words.join(known, "token", "left_anti").agg(F.count("*").alias("palabras_desconocidas")),
            new.agg(F.count("*").alias("pares")), members.join(scope, "clave", "left_semi").agg(F.count("*").alias("claves_reagrupadas")),
        )
        counts = {"carga": version, **{k: v for df in figures for k, v in df.first().asDict().items()}}  # one row each
        write(self.spark.createDataFrame([counts], STATE["drift"]), "drift")
        remove(self.spark, f"{self.folder}/v={version - 2}", keep="drift")

    def drift(self) -> DataFrame:
        """Figures of every load."""
        return self.spark.read.schema(STATE["drift"]).parquet(f"{self.folder}/v=*/drift")

    def _keys(self, rows: DataFrame, nodes: DataFrame) -> DataFrame:
        """``(clave, state, new, fresh)`` of the load's keys, with what is known of them taken in."""
        best = F.struct(F.when(F.col("truncado"), 0).otherwise(1).alias("whole"), F.length("limpio").alias("len"), "limpio", "nucleo")
        mine = resolution.employers(rows).select("clave", best.alias("best"), F.struct("idx", "tokens").alias("first"), "truncado", F.lit(1).cast("long").alias("n_registros"), F.lit(False).alias("old"))
        both = mine.unionByName(nodes.join(mine.select("clave").distinct(), "clave", "left_semi").withColumn("old", F.lit(True)))
        held = lambda c: F.max(F.when(F.col("old"), F.col(c)))
        state = F.struct(F.max("best").alias("best"), F.min("first").alias("first"), F.bool_or("truncado").alias("truncado"), F.sum("n_registros").alias("n_registros"))
        out = both.groupBy("clave").agg(state.alias("state"), F.struct(*(held(c).alias(c) for c in ("best", "first", "truncado"))).alias("was"), (~F.bool_or("old")).alias("new"))
        same = F.lit(True)
        for c in ("best.whole", "best.limpio", "best.nucleo", "first.tokens", "truncado"):
            same = same & F.col(f"state.{c}").eqNullSafe(F.col(f"was.{c}"))
        return out.select("clave", "state", "new", (F.col("new") | ~same).alias("fresh"))

    def _flipped(self, before: DataFrame, after: DataFrame, fresh: DataFrame) -> DataFrame:
        """Keys of blocks that became useful or stopped to be: no more of each than a useful block holds."""
        touched = before.join(fresh, "clave", "left_semi").select("signal").union(after.join(fresh, "clave", "left_semi").select("signal")).distinct()
        size = lambda s, name: s.join(touched, "signal", "left_semi").groupBy("signal").agg(F.count("*").alias(name))
        useful = lambda c: F.coalesce(F.col(c), F.lit(0)).between(2, SETTINGS.largest_block)
        sizes = durable(size(before, "x").join(size(after, "y"), "signal", "full").select("signal", useful("x").alias("was"), useful("y").alias("now")), "blocks")
        lost, won = sizes.where("was and not now"), sizes.where("now and not was")
        return before.join(lost, "signal", "left_semi").select("clave").union(after.join(won, "signal", "left_semi").select("clave"))

    def _candidates(self, signals: DataFrame, dirty: DataFrame) -> DataFrame:
        """Pairs (a, b) in useful blocks, one end at least among the keys to decide."""
        mine = signals.join(dirty, "clave", "left_semi")
        held = signals.join(mine.select("signal").distinct(), "signal", "left_semi")
        useful = resolution.block_sizes(held).where(F.col("size").between(2, SETTINGS.largest_block)).select("signal")
        pairs = mine.join(useful, "signal").select("signal", F.col("clave").alias("x")).join(held.select("signal", F.col("clave").alias("y")), "signal")
        return pairs.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    def _scope(self, members: DataFrame, dirty: DataFrame, new: DataFrame) -> DataFrame:
        """Keys of all components that lose or gain a pair."""
        ends = dirty.union(new.select("a")).union(new.select("b")).distinct()
        parts = members.join(ends, "clave", "left_semi").select("component").distinct()
        return durable(members.join(parts, "component", "left_semi").select("clave").union(ends).distinct(), "scope")

    def _clustered(self, accepted: DataFrame, nodes: DataFrame, scope: DataFrame) -> DataFrame:
        pairs = durable(accepted.join(scope.select(F.col("clave").alias("a")), "a", "left_semi").select("a", "b", "score", F.lit(True).alias("accepted")), "scoped")
        merged = resolution.guarded_clusters(pairs, _plain(nodes.join(scope, "clave", "left_semi")), self.statistics.generic)
        member = merged.where("kind = 'member'").select(F.col("a").alias("clave"), F.col("b").alias("cluster"))
        joint = resolution.components(pairs).select(F.col("node").alias("clave"), "component")
        out = scope.join(member, "clave", "left").join(joint, "clave", "left")
        return out.select("clave", F.coalesce("cluster", "clave").alias("cluster"), F.coalesce("component", "clave").alias("component"))


def _plain(nodes: DataFrame) -> DataFrame:
    """State rows in the form of ``resolution.nodes``."""
    return resolution.with_reduced(nodes.select("clave", F.col("best.limpio").alias("limpio"), F.col("best.nucleo").alias("nucleo"), F.col("first.tokens").alias("tokens"), "truncado", "n_registros"))


def maintain(stream: DataFrame, master: Master, checkpoint: str):
    """Starts a query that takes what has arrived into the master, a micro-batch a load."""
    ship(stream.sparkSession)
    return stream.writeStream.foreachBatch(master.load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
