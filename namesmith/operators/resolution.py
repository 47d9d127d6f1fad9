"""Entity resolution: exact groups, blocking, pair decisions, guarded clustering.

Pairs are only ever made inside a block, and a block's size is known (and bounded) before any pair is made: the size
comes from an aggregate over signals, so oversized blocks never reach the self-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import text as T
from ..functions.rules import SETTINGS
from ..functions.similarity import _sorted, length_bound, ratio, token_sort_ratio
from ..storage import durable


def employers(records: DataFrame) -> DataFrame:
    return records.where(T.one_of(F.col("tipo"), *rules.EMPLOYER_TYPES))


def others(records: DataFrame) -> DataFrame:
    return records.where(~T.one_of(F.col("tipo"), *rules.EMPLOYER_TYPES))


def exact_groups(records: DataFrame) -> DataFrame:
    """``(clave, n)`` of keys that several employer records share."""
    return employers(records).groupBy("clave").agg(F.count("*").alias("n")).where("n > 1")


def group_members(records: DataFrame) -> DataFrame:
    """``(clave, n, idx)``: the members of keys that several employer records share, a row each: no group has to fit a task."""
    return employers(records).select("clave", "idx").join(exact_groups(records), "clave").select("clave", "n", "idx")


def nodes(records: DataFrame) -> DataFrame:
    """One row for each employer key: its best text, the core, and the first record's tokens."""
    best = F.struct(F.when(F.col("truncado"), 0).otherwise(1).alias("whole"), F.length("limpio").alias("len"), F.col("limpio"), F.col("nucleo"))
    grouped = employers(records).groupBy("clave").agg(
        F.max(best).alias("best"), F.min(F.struct("idx", "tokens")).alias("first"), F.bool_or("truncado").alias("truncado"), F.count("*").alias("n_registros"),
    )
    out = grouped.select("clave", F.col("best.limpio").alias("limpio"), F.col("best.nucleo").alias("nucleo"), F.col("first.tokens").alias("tokens"), "truncado", "n_registros")
    return with_reduced(out)


def with_reduced(node: DataFrame) -> DataFrame:
    return node.withColumn("reducido", T.text_of(T.remove_qualifiers(T.tokens_of(F.col("nucleo")))))


def rare_tokens(node: DataFrame, frequency: DataFrame) -> DataFrame:
    """``(clave, token, df, rank)``: the three rarest tokens of each key."""
    able = F.filter(F.array_distinct("tokens"), lambda t: (F.length(t) >= 2) & ~T.one_of(t, *rules.STOPWORDS))
    own = node.select("clave", F.explode(T.unless_empty(able, F.array_distinct("tokens"))).alias("token"))
    measured = own.join(frequency, "token", "left").select("clave", "token", F.coalesce("df", F.lit(1)).cast("long").alias("df"))
    order = Window.partitionBy("clave").orderBy("df", "token")
    return measured.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SETTINGS.rare_tokens)


def signals(rare: DataFrame) -> DataFrame:
    """``(signal, clave)``, distinct: each rare token and, if it is long, its head and tail."""
    long = F.length("token") >= SETTINGS.affix_least
    all_ = F.array(F.concat(F.lit("T:"), "token"), F.when(long, F.concat(F.lit("P:"), F.substring("token", 1, SETTINGS.affix))), F.when(long, F.concat(F.lit("S:"), F.expr(f"right(token, {SETTINGS.affix})"))))
    return rare.select(F.explode(F.filter(all_, lambda s: s.isNotNull())).alias("signal"), "clave").distinct()


def block_sizes(signal: DataFrame) -> DataFrame:
    return signal.groupBy("signal").agg(F.count("*").alias("size"))


def block_stats(signal: DataFrame) -> DataFrame:
    """One row: signals, useful and oversized blocks, pairs that the useful ones hold."""
    size = F.col("size")
    useful = (size >= 2) & (size <= SETTINGS.largest_block)
    return block_sizes(signal).agg(
        F.count("*").alias("n_signals"), F.count_if(useful).alias("n_useful"), F.count_if(size > SETTINGS.largest_block).alias("n_oversized"),
        F.coalesce(F.sum(F.when(useful, size * (size - 1) / 2)), F.lit(0)).cast("long").alias("n_pairs"),
    )


def candidate_pairs(signal: DataFrame) -> DataFrame:
    """``(a, b)`` of keys that share a useful block, each pair once, a < b."""
    useful = block_sizes(signal).where(F.col("size").between(2, SETTINGS.largest_block)).select("signal")
    kept = signal.join(useful, "signal")
    left, right = kept.select("signal", F.col("clave").alias("a")), kept.select("signal", F.col("clave").alias("b"))
    return left.join(right, "signal").where("a < b").select("a", "b").distinct()


def truncation(short: str, long: str) -> Column:
    """Whether ``short``'s text is the cut-off form of ``long``'s (column name prefixes)."""
    s, l = F.col(f"{short}_limpio"), F.col(f"{long}_limpio")
    return F.col(f"{short}_truncado") & (F.length(s) < F.length(l)) & (F.length(s) >= SETTINGS.prefix_least) & F.length(s).isin(*SETTINGS.field_limits) & l.startswith(s)


#: Into how many parts the names that begin alike are dealt; each cut-off name goes to all of them.
SALTS = 16


def truncation_join(node: DataFrame) -> DataFrame:
    """``(a, b)``: each cut-off name a with every longer name b that it begins, whether or not they share a useful block.

    An equi-join on as many first letters as a field holds. Many names may begin alike, few of them are cut off: so the
    longer ones are dealt by a salt too, and the cut-off ones repeated for each salt. Null texts match nothing.
    """
    own = node.where("truncado").select(F.col("clave").alias("a"), F.col("limpio").alias("head")).where(F.length("head").isin(*SETTINGS.field_limits) & (F.length("head") >= SETTINGS.prefix_least))
    own = own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    cuts = F.array_compact(F.array(*[F.when(F.length("limpio") > n, F.substring("limpio", 1, n)) for n in SETTINGS.field_limits]))
    longer = node.select(F.col("clave").alias("b"), F.explode(cuts).alias("head"), F.pmod(F.xxhash64("clave"), F.lit(SALTS)).cast("int").alias("salt"))
    return own.join(longer, ["head", "salt"]).where("a <> b").select("a", "b")


def with_ends(pairs: DataFrame, node: DataFrame) -> DataFrame:
    """Joins both ends' columns to pairs (a, b) as a_... and b_..."""
    out = pairs
    for end in ("a", "b"):
        own = node.select(F.col("clave").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in ("limpio", "nucleo", "reducido", "tokens", "truncado")])
        out = out.join(own, end)
    return out


def decide(pairs: DataFrame, node: DataFrame, rare: DataFrame, cut: int) -> DataFrame:
    """``(a, b, shared, score, accepted)``: cut-off names are the same; others need a score by the rare tokens they share."""
    kept = rare.where(F.col("df") < cut).groupBy("clave").agg(F.collect_list("token").alias("rare"))
    both = with_ends(pairs, node)
    for end in ("a", "b"):
        both = both.join(kept.select(F.col("clave").alias(end), F.col("rare").alias(f"{end}_rare")), end, "left")
    none = F.array().cast("array<string>")
    shared = F.size(F.array_intersect(F.coalesce("a_rare", none), F.coalesce("b_rare", none)))
    need = F.when(F.col("shared") >= 2, SETTINGS.accept[0]).when(F.col("shared") == 1, SETTINGS.accept[1]).otherwise(SETTINGS.accept[2])
    both = both.withColumn("shared", shared.cast("long")).withColumn("need", need)
    cut_off = truncation("a", "b") | truncation("b", "a")
    both = both.withColumn("cut_off", cut_off)
    able = ~F.col("cut_off") & length_bound(F.col("a_nucleo"), F.col("b_nucleo"), SETTINGS.accept[0])
    # The kernel sees null, and does nothing, where lengths already decide.
    score = token_sort_ratio(F.when(able, F.col("a_nucleo")), F.when(able, F.col("b_nucleo")))
    out = both.withColumn("score", F.when(F.col("cut_off"), 100.0).otherwise(F.coalesce(score, F.lit(0.0))))
    return out.select("a", "b", "shared", "score", (F.col("cut_off") | (F.col("score") >= F.col("need"))).alias("accepted"))


def cohesion(pairs: DataFrame, node: DataFrame) -> DataFrame:
    """``(a, b, cohesion)``: 100 for a long prefix, or else the better of both token-sort ratios."""
    both = with_ends(pairs, node)
    prefix = lambda s, l: (F.length(f"{s}_limpio") >= SETTINGS.prefix_least) & F.col(f"{l}_limpio").startswith(F.col(f"{s}_limpio"))
    value = F.greatest(token_sort_ratio(F.col("a_nucleo"), F.col("b_nucleo")), token_sort_ratio(F.col("a_reducido"), F.col("b_reducido")))
    return both.select("a", "b", F.when(prefix("a", "b") | prefix("b", "a"), 100.0).otherwise(value).alias("cohesion"))


#: Edges up to which one task finds the components of a graph; beyond, rounds of joins do.
SMALL_GRAPH = 500_000


def _one_task(batches):
    import pyarrow as pa

    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)  # a root is the least of its nodes
    nodes = list(parent)
    yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.string()), "component": pa.array([root(x) for x in nodes], pa.string())})


def components(edges: DataFrame, small: int = SMALL_GRAPH) -> DataFrame:
    """``(node, component)`` of an undirected graph (a, b); a component is named by its smallest node.

    A graph of at most ``small`` edges, counted first, is one task's. Of a larger one every round each node takes the name
    of least hash among itself and its neighbours, with another hash every time, and the graph contracts to those names,
    so even a long path shrinks by a share of itself; the renamings are composed. State lies in written tables, so lost
    executors cost a reread only.
    """
    edges = durable(edges.select("a", "b").where("a <> b").distinct(), "edges")
    if edges.count() <= small:
        return durable(edges.coalesce(1).mapInArrow(_one_task, "node string, component string"), "components")
    ends = edges
    steps = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        place = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(steps))).alias("h"), F.col(c).alias("n"))
        step = durable(both.groupBy("a").agg(F.min(place("b")).alias("m")).select(F.col("a").alias("node"), F.least(place("a"), "m")["n"].alias("to")), "step")
        steps.append(step)
        x, y = step.select(F.col("node").alias("a"), F.col("to").alias("x")), step.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = durable(edges.join(x, "a").join(y, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
    out = ends.select(F.col("a").alias("node")).union(ends.select(F.col("b").alias("node"))).distinct().withColumn("at", F.col("node"))
    for step in steps:
        out = out.join(step.select(F.col("node").alias("at"), "to"), "at", "left").select("node", F.coalesce("to", "at").alias("at"))
    least = out.groupBy("at").agg(F.min("node").alias("component"))
    return out.join(least, "at").select("node", "component")


def _prefix_or_ratio(x, y) -> float:
    for s, l in ((x, y), (y, x)):
        if len(s[0]) >= SETTINGS.prefix_least and l[0].startswith(s[0]):
            return 100.0
    return max(ratio(_sorted(x[1]), _sorted(y[1])), ratio(_sorted(x[2]), _sorted(y[2])))


def _merge(pairs: list[tuple], ends: dict[str, tuple]) -> list[tuple]:
    """Replays the merges of one component of clusters, best pair first, under the cohesion of the representatives.

    ``pairs``: (score, a, b, x, y), names a and b of clusters x and y; ``ends``: cluster -> (limpio, nucleo, reducido,
    truncado, name) of its representative. Gives (x, its cluster now, None, name of that one's representative), and
    (x, y, cohesion, None) of clusters that stayed apart, with the best of each pair's values.
    """
    parent, speaker = {k: k for k in ends}, dict(ends)

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    apart = []
    for *_, x, y in sorted(pairs, key=lambda p: (-p[0], p[1], p[2])):
        x, y = sorted((root(x), root(y)))
        if x == y:
            continue
        value = _prefix_or_ratio(speaker[x], speaker[y])
        if value >= SETTINGS.cohesion:
            parent[y] = x
            speaker[x] = max(speaker[x], speaker[y], key=lambda n: (not n[3], len(n[0]), n[0]))
        else:
            apart.append((x, y, value))
    best: dict = {}
    for x, y, value in apart:
        pair = tuple(sorted((root(x), root(y))))
        if pair[0] != pair[1]:
            best[pair] = max(value, best.get(pair, 0.0))
    return [(k, root(k), None, speaker[root(k)][4]) for k in ends] + [(x, y, value, None) for (x, y), value in best.items()]


_REPLAYED = "x string, y string, cohesion double, voice string"
_VOICE = ("limpio", "nucleo", "reducido", "truncado", "voice")


def _replay(batches):
    """Rows of components, one after the other; memory holds one component."""
    import pyarrow as pa

    kinds = (pa.string(), pa.string(), pa.float64(), pa.string())
    now, pairs, ends, out = None, [], {}, []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=["x", "y", "cohesion", "voice"])

    for rows in batches:
        for r in rows.to_pylist():
            if r["component"] != now:
                out += _merge(pairs, ends)
                now, pairs, ends = r["component"], [], {}
            pairs.append((r["score"], r["a"], r["b"], r["x"], r["y"]))
            for e in ("x", "y"):
                ends[r[e]] = tuple(r[f"{e}_{c}"] for c in _VOICE)
        if len(out) > 10000:
            yield batch()
            out = []
    out += _merge(pairs, ends)
    yield batch()


#: Pairs of one component that a task replays at once, and the ranges into which those of a larger one are dealt.
COMPONENT, RANGES = 100_000, 4


class _Replay:
    """Merges in the global order of pairs, with no group of more than ``bound`` pairs.

    No merge can cross a connected component, so each is replayed on its own. The pairs of one with more than ``bound`` are
    dealt into ranges of the order: the first is settled, by the same rule, then the clusters that the next one's pairs
    now belong to are looked up, and so on. A part of the pairs falls into many more components than all of them, so a
    range is mostly small ones side by side; one of ``bound`` pairs or fewer can't be too large.

    ``owner``: (name, cluster) and ``voices``: (cluster, name of its representative), of what has been replayed so far;
    ``apart``: the pairs of clusters that stayed apart at the end of some range, with their cohesion.
    """

    def __init__(self, node: DataFrame, bound: int):
        self.node, self.bound, self.owner, self.voices, self.apart = node, bound, None, None, []

    def settle(self, pairs: DataFrame) -> None:
        """Decides pairs (score, a, b, x, y) of which none comes before one decided already."""
        joint = components(pairs.select(F.col("x").alias("a"), F.col("y").alias("b")))
        named = durable(pairs.join(joint.select(F.col("node").alias("x"), "component"), "x"), "joint")
        sizes = named.groupBy("component").agg(F.count("*").alias("n"))
        large = sizes.where(F.col("n") > self.bound).select("component")
        some = not large.isEmpty()
        self.replay(named.join(large, "component", "left_anti") if some else named)
        if not some:
            return
        order = (F.desc("score"), "a", "b")
        rest = named.join(large, "component", "left_semi").select("score", "a", "b", "x", "y")
        rest = durable(rest.repartitionByRange(RANGES, *order).withColumn("part", F.spark_partition_id()), "ranges")
        for (part,) in sorted(rest.select("part").distinct().collect()):  # as many as there are ranges
            own = rest.where(F.col("part") == part).drop("part")
            if self.owner is not None:
                own = self.now(own, "x", "y")
            own = durable(own.where("x <> y"), "range")
            if not own.isEmpty():
                self.settle(own)

    def now(self, rows: DataFrame, *columns: str) -> DataFrame:
        """Replaces clusters by what they have become."""
        for c in columns:
            moved = self.owner.select(F.col("name").alias(c), F.col("cluster").alias("_now"))
            rows = rows.join(moved, c, "left").withColumn(c, F.coalesce("_now", c)).drop("_now")
        return rows

    def replay(self, named: DataFrame) -> None:
        full = named
        for end in ("x", "y"):
            if self.voices is None:
                own = self.node.withColumn("voice", F.col("clave")).withColumnRenamed("clave", end)
            else:
                said = self.voices.select(F.col("cluster").alias(end), "voice")
                said = full.select(end).distinct().join(said, end, "left").withColumn("voice", F.coalesce("voice", end))
                own = said.join(self.node.withColumnRenamed("clave", "voice"), "voice")
            full = full.join(own.select(end, *(F.col(c).alias(f"{end}_{c}") for c in _VOICE)), end)
        done = durable(full.repartition("component").sortWithinPartitions("component").mapInArrow(_replay, _REPLAYED), "replayed")
        self.apart.append(done.where("voice is null").select("x", "y", "cohesion"))
        moved = done.where("voice is not null")
        if self.owner is None:
            self.owner = moved.select(F.col("x").alias("name"), F.col("y").alias("cluster"))
            self.voices = moved.select(F.col("y").alias("cluster"), "voice").distinct()
            return
        new = moved.select(F.col("x").alias("cluster"), F.col("y").alias("_now"))
        kept = self.owner.join(new, "cluster", "left").select("name", F.coalesce("_now", "cluster").alias("cluster"))
        fresh = moved.join(self.owner.select(F.col("name").alias("x")), "x", "left_anti").select(F.col("x").alias("name"), F.col("y").alias("cluster"))
        before = self.voices.join(new.select("cluster"), "cluster", "left_anti")
        self.owner = durable(kept.union(fresh), "owner")
        self.voices = durable(before.union(moved.select("y", "voice").distinct()), "voices")


_MERGED = ("kind", "a", "b", "cohesion", "representante_a", "representante_b", "tokens_distintivos")


def guarded_clusters(decided: DataFrame, node: DataFrame, generic: list[str] = (), bound: int = COMPONENT) -> DataFrame:
    """``(kind, a, b, cohesion, representante_a, representante_b, tokens_distintivos)``: members (a in cluster b), doubtful and discarded pairs of clusters.

    The accepted pairs are decided in the order of score, then names (``_Replay``). Pairs of clusters carry both
    representatives' texts and how many words that aren't ``generic`` they share.
    """
    accepted = decided.where("accepted").select("score", "a", "b", F.col("a").alias("x"), F.col("b").alias("y"))
    run = _Replay(node, bound)
    run.settle(durable(accepted, "accepted"))
    apart = run.apart[0]
    if len(run.apart) > 1:
        for more in run.apart[1:]:
            apart = apart.union(more)
        apart = run.now(apart, "x", "y").where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "cohesion")
        apart = apart.groupBy("x", "y").agg(F.max("cohesion").alias("cohesion"))
    for end in ("x", "y"):
        voice = run.voices.select(F.col("cluster").alias(end), "voice").join(node.withColumnRenamed("clave", "voice"), "voice")
        apart = apart.join(voice.select(end, F.col("limpio").alias(f"{end}_limpio"), F.col("tokens").alias(f"{end}_tokens")), end)
    shared = F.array_except(F.array_intersect("x_tokens", "y_tokens"), F.array(*map(F.lit, generic)).cast("array<string>"))
    kind = F.when(F.col("cohesion") >= SETTINGS.doubt, "doubt").otherwise("discarded")
    apart = apart.select(kind, "x", "y", "cohesion", "x_limpio", "y_limpio", F.size(shared)).toDF(*_MERGED)
    none = F.lit(None)
    return run.owner.select(F.lit("member"), "name", "cluster", none.cast("double"), none.cast("string"), none.cast("string"), none.cast("int")).toDF(*_MERGED).union(apart)


def doubt_list(merged: DataFrame, kind: str = "doubt") -> DataFrame:
    """Doubtful (or discarded) pairs with their place in the review: most shared distinctive words, most cohesion, then names."""
    return numbered(merged.where(F.col("kind") == kind).drop("kind"), "orden", 1, F.desc("tokens_distintivos"), F.desc("cohesion"), "a", "b")


def component_sizes(member: DataFrame, group: str = "component") -> DataFrame:
    """``(group, n)`` of groups with several members."""
    return member.groupBy(group).agg(F.count("*").alias("n")).where("n > 1")


def cluster_summary(member: DataFrame, node: DataFrame) -> DataFrame:
    """One row: keys, clusters, clusters of several keys, records in those. ``member``: (clave, cluster)."""
    sizes = member.join(node.select("clave", "n_registros"), "clave").groupBy("cluster").agg(F.count("*").alias("k"), F.sum("n_registros").alias("n"))
    several = F.col("k") > 1
    return sizes.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("claves"), F.count("*").alias("clusters"), F.count_if(several).alias("clusters_multiples"), F.coalesce(F.sum(F.when(several, F.col("n"))), F.lit(0)).alias("registros_en_multiples"))


def clusters(merged: DataFrame, node: DataFrame) -> DataFrame:
    """``(clave, cluster, stable_id)`` of every key; a key without partners is a cluster of its own."""
    member = merged.where("kind = 'member'").select(F.col("a").alias("clave"), F.col("b").alias("cluster"))
    out = node.select("clave").join(member, "clave", "left").select("clave", F.coalesce("cluster", "clave").alias("cluster"))
    return out.withColumn("stable_id", F.sha2("cluster", 256))


def size_rank(members: DataFrame) -> DataFrame:
    """``(cluster, n, rank)``: clusters numbered by size, largest first, then by name."""
    return numbered(members.groupBy("cluster").agg(F.count("*").alias("n")), "rank", 1, F.desc("n"), "cluster")


def numbered(df: DataFrame, name: str, first: int, *order) -> DataFrame:
    """Adds ``name``, a place in the given order: rows are dealt by ranges of the order, and each range begins where those before end."""
    placed = durable(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    before = placed.groupBy("_part").agg(F.count("*").alias("_k")).withColumn("_before", F.coalesce(F.sum("_k").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row a range
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return placed.join(F.broadcast(before), "_part").withColumn(name, (F.col("_before") + within + F.lit(first - 1)).cast("long")).drop("_part", "_k", "_before")
