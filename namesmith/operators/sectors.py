"""Economic sector: evidence cascade of a record, vote of a cluster, propagation over doubtful pairs, reclassification."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import text as T
from ..functions.rules import SETTINGS
from ..functions.similarity import _sorted, best_match
from ..storage import durable
from .knowledge import Knowledge
from .lexicon import approximate_candidates, commercial_prefix, near_words, once
from .records import gazetteer_key, horizontal_property


def phrase(nucleo: Column, knowledge: Knowledge) -> Column:
    """The longest catalogue phrase within the text (null if none)."""
    return F.get(F.filter(F.array(*[F.lit(p.key) for p in knowledge.phrases]), lambda p: F.contains(nucleo, p)), F.lit(0))


def _in_catalogue(tokens: Column, knowledge: Knowledge) -> Column:
    return F.filter(F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.alias("i"))), lambda x: T.one_of(x["t"], *knowledge.words))


def best_token(tokens: Column, knowledge: Knowledge) -> Column:
    """The catalogue word of most weight, the earliest of equals (null if none)."""
    weighed = F.transform(_in_catalogue(tokens, knowledge), lambda x: F.struct(knowledge.field(x["t"], "weight").alias("w"), (-x["i"]).alias("i"), x["t"].alias("t")))
    return F.array_max(weighed)["t"]


def first_token(tokens: Column, knowledge: Knowledge) -> Column:
    return F.get(_in_catalogue(tokens, knowledge), F.lit(0))["t"]


def approximate(df: DataFrame, knowledge: Knowledge, tokens: str = "tokens") -> DataFrame:
    """Adds ``aprox``: the catalogue word that the first matching token is a variant or near-miss of ('' if none).

    Each distinct list of able tokens is resolved once. Rows without such tokens take no part in the join.
    """
    made = durable(df.withColumn("_able", F.array_join(approximate_candidates(F.col(tokens), knowledge), " ")), "able")
    able = made.where("_able <> ''")
    listed = able.select("_able").distinct().select("_able", F.posexplode(F.split("_able", " ")).alias("_i", "text"))
    hits = near_words(listed, knowledge)
    first = listed.join(hits, "text").groupBy("_able").agg(F.min_by("hit", "_i").alias("aprox"))
    found = able.join(first, "_able", "left").withColumn("aprox", F.coalesce("aprox", F.lit("")))
    none = made.where("_able = '' or _able is null").withColumn("aprox", F.lit(""))
    return found.unionByName(none).drop("_able")


def cascade(df: DataFrame, knowledge: Knowledge) -> DataFrame:
    """Adds ``nivel, evidencia, seccion, division, peso`` to ``(nucleo, tokens, sufijo_societario)``: the strongest evidence.

    Each level is an array of at most one struct, so that every expression stands in the plan once; the first wins.
    """
    tokens = F.col("tokens")
    prefixes = F.filter(F.transform(tokens, lambda t: commercial_prefix(t, knowledge)), lambda p: p != "")
    prefix_field = lambda p, i: F.element_at(T.constant_map({r[0]: r[i] for r in rules.COMMERCIAL_PREFIXES}), p)

    def found(level, key, section, division, weight=None):
        return F.struct(F.lit(level).alias("nivel"), key.alias("evidencia"), section.alias("seccion"), division.alias("division"), (F.lit(5) if weight is None else weight).cast("int").alias("peso"))

    def level(name, keys, section, division, weight=None):
        """``keys``: an array whose first text that isn't null or empty is the evidence."""
        present = F.slice(F.filter(keys, lambda k: k.isNotNull() & (k != "")), 1, 1)
        return F.transform(present, lambda k: found(name, k, section(k), division(k), weight(k) if weight else None))

    of = lambda name: lambda k: knowledge.field(k, name)
    levels = [
        level("gazetteer", F.array(gazetteer_key(tokens, knowledge)), lambda k: knowledge.employer(k, "section"), lambda k: knowledge.employer(k, "division")),
        level("propiedad_horizontal", F.array(F.when(horizontal_property(tokens, F.col("sufijo_societario")), F.lit("PH"))), lambda k: F.lit("L"), lambda k: F.lit("68")),
        level("frase", F.array(phrase(F.col("nucleo"), knowledge)), of("section"), of("division")),
        level("token", F.array(best_token(tokens, knowledge)), of("section"), of("division"), of("weight")),
        level("prefijo_comercial", prefixes, lambda k: prefix_field(k, 1), lambda k: prefix_field(k, 2)),
        level("token_aproximado", F.array("aprox"), of("section"), of("division")),
        F.array(found("sin_evidencia", F.lit(""), F.lit(""), F.lit(""))),
    ]
    rows = approximate(df, knowledge).withColumn("_evidence", F.element_at(F.concat(*levels), 1)).drop("aprox")
    return rows.select(*[c for c in rows.columns if c != "_evidence"], "_evidence.*")


#: Votes by level; a token votes with the weight of the first catalogue word.
VOTES = {"gazetteer": 20, "propiedad_horizontal": 15, "frase": 10, "prefijo_comercial": 4, "token_aproximado": 3}


def vote(df: DataFrame, knowledge: Knowledge, cluster: str = "cluster") -> DataFrame:
    """``(cluster, seccion, division, votos, nivel)``: each distinct core votes once, by its strongest evidence.

    Ties go to the greater (section, division); the level is the strongest that voted for the winner.
    """
    distinct = df.select(F.col(cluster).alias("cluster"), "nucleo", "tokens", "sufijo_societario").groupBy("cluster", "nucleo").agg(F.min("tokens").alias("tokens"), F.min("sufijo_societario").alias("sufijo_societario"))
    own = cascade(distinct, knowledge).where("seccion <> ''")
    weight = knowledge.field(first_token(F.col("tokens"), knowledge), "weight")
    votes = F.when(F.col("nivel") == "token", weight)
    for level, n in VOTES.items():
        votes = votes.when(F.col("nivel") == level, F.lit(n))
    rank = F.when(F.col("nivel") == "token", weight)
    for level, n in VOTES.items():
        rank = rank.when(F.col("nivel") == level, F.lit(n))
    sums = own.select("cluster", "seccion", "division", votes.cast("long").alias("v"), F.struct(rank.alias("r"), F.col("nivel")).alias("l"))
    sums = sums.groupBy("cluster", "seccion", "division").agg(F.sum("v").alias("v"), F.max("l").alias("l"))
    best = sums.groupBy("cluster").agg(F.max(F.struct("v", "seccion", "division", F.col("l.nivel").alias("nivel"))).alias("w"))
    return best.select("cluster", F.col("w.seccion").alias("seccion"), F.col("w.division").alias("division"), F.col("w.v").alias("votos"), F.col("w.nivel").alias("nivel"))


def strong_evidence(level: Column, weight: Column) -> Column:
    return level.isin("gazetteer", "frase", "propiedad_horizontal") | (level == "token") & weight.between(7, 9)


def propagate(resolved: DataFrame, doubts: DataFrame, knowledge: Knowledge) -> DataFrame:
    """``(cluster, seccion, division, fuente, cohesion)`` that unclassified clusters inherit from doubtful neighbours.

    ``resolved``: (cluster, representante, seccion, division, nivel, peso); ``doubts``: (a, b, cohesion) of clusters. Only
    strong evidence is passed on, once, and not where a proper noun is all that both names share. The neighbour of
    highest (distinctive words shared, cohesion), then of smallest name, gives; where ``doubts`` don't carry
    ``tokens_distintivos``, all words that both texts share count.
    """
    given = "tokens_distintivos" in doubts.columns
    marks = ["cohesion", *(["tokens_distintivos"] if given else [])]
    both = doubts.select("a", "b", *marks).union(doubts.select("b", "a", *marks))
    source = resolved.where(F.coalesce("seccion", F.lit("")) != "").where(strong_evidence(F.col("nivel"), F.col("peso")))
    source = source.select(F.col("cluster").alias("a"), F.col("representante").alias("ra"), "seccion", "division")
    target = resolved.where((F.coalesce("seccion", F.lit("")) == "") & (F.coalesce("nivel", F.lit("")) != "reclasificacion")).select(F.col("cluster").alias("b"), F.col("representante").alias("rb"))
    pairs = both.join(source, "a").join(target, "b")
    shared = T.without(F.array_intersect(F.split("ra", " "), F.split("rb", " ")), rules.STOPWORDS)
    pairs = pairs.withColumn("comunes", shared).where((F.size("comunes") == 0) | ~F.forall("comunes", lambda t: T.one_of(t, *knowledge.proper_nouns)))
    order = Window.partitionBy("b").orderBy(F.desc("tokens_distintivos") if given else F.desc(F.size("comunes")), F.desc("cohesion"), "a")
    return pairs.withColumn("k", F.row_number().over(order)).where("k = 1").select(F.col("b").alias("cluster"), "seccion", "division", F.col("a").alias("fuente"), "cohesion")


MARKERS = tuple(sorted({*rules.INACTIVE, *rules.ANNOTATIONS}))


def reclassified(text: Column) -> Column:
    """The marker of an inactive person or annotation that a representative resembles by 88 or more ('' if none)."""

    names = {_sorted(m): m for m in reversed(MARKERS)}  # the first of markers with the same words
    order = sorted(names, key=lambda s: MARKERS.index(names[s]))

    def best(column: pd.Series) -> pd.Series:
        texts = column.map(_sorted)
        found = best_match(list(texts), order, SETTINGS.reclassify)
        return texts.map(lambda t: names.get(found[t], ""))

    best.__annotations__ = {}
    return once(best, "string")(text)
