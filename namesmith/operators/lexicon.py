"""What single tokens mean: typo correction, morphological variants, commercial prefixes, approximate matches.

Exact lookups stay in the JVM. Tokens that could be corrected are a dimension of their own: the distinct ones meet the
vocabulary in a similarity join, and what they have become is joined back to the records that hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import text as T
from ..functions.rules import SETTINGS
from ..storage import durable
from . import likeness
from .knowledge import Knowledge


def once(f, kind: str):
    """An Arrow function that the optimizer neither repeats nor moves: filters on what follows from it stay above it.

    Deterministic functions would be copied, with all they read, into every filter that is pushed through.
    """
    return F.pandas_udf(f, kind, F.PandasUDFType.SCALAR).asNondeterministic()


def _typo_ok(token: Column, target: Column) -> Column:
    part = token.startswith(target) | target.startswith(token) | token.endswith(target) | target.endswith(token)
    return (F.abs(F.length(token) - F.length(target)) <= SETTINGS.typo_gap) & ~part


def typo_correction(rows: DataFrame, knowledge: Knowledge) -> DataFrame:
    """``(idx, ..., palabras)`` with words of 8 letters or more that no vocabulary knows replaced by a very similar marker or catalogue word.

    Distinct words meet the vocabulary once; a record is joined only with the corrections that it needs.
    """
    rows = durable(rows, "words")
    able = F.filter("palabras", lambda t: (F.length(t) >= SETTINGS.typo_length) & ~T.one_of(t, *knowledge.known))
    open_ = rows.select("idx", F.explode(able).alias("text"))
    fixes = likeness.best(open_.select("text").distinct(), likeness.vocabulary(rows.sparkSession, sorted(knowledge.typo_targets)), SETTINGS.typo_ratio, _typo_ok)
    held = open_.join(fixes, "text").groupBy("idx").agg(F.map_from_entries(F.collect_set(F.struct("text", "word"))).alias("_fixes"))
    fixed = F.when(F.col("_fixes").isNull(), F.col("palabras")).otherwise(F.transform("palabras", lambda t: F.coalesce(F.element_at("_fixes", t), t)))
    return rows.join(held, "idx", "left").withColumn("palabras", fixed).drop("_fixes")


def morphological_variant(token: Column, knowledge: Knowledge) -> Column:
    """The catalogue word of weight 6 or more that the token is a plural or singular of ('' if none)."""
    able = sorted(k for k, r in knowledge.words.items() if r.weight >= SETTINGS.approximate_weight)
    forms = [F.concat(token, F.lit("S")), F.concat(token, F.lit("ES"))]
    cut = [(F.regexp_replace(token, "S$", ""), token.endswith("S")), (F.regexp_replace(token, "ES$", ""), token.endswith("ES"))]
    tries = [F.when(T.one_of(f, *able), f) for f in forms] + [F.when(ends & T.one_of(f, *able), f) for f, ends in cut]
    return F.when(F.length(token) >= SETTINGS.morphology_length, F.coalesce(*tries, F.lit(""))).otherwise(F.lit(""))


def commercial_prefix(token: Column, knowledge: Knowledge) -> Column:
    """The trade prefix that starts a longer token which isn't a catalogue word itself ('' if none)."""
    out = F.when(T.one_of(token, *knowledge.words), F.lit(""))
    for prefix, *_ in rules.COMMERCIAL_PREFIXES:
        out = out.when(token.startswith(prefix) & (F.length(token) >= len(prefix) + SETTINGS.prefix_extra), F.lit(prefix))
    return out.otherwise(F.lit(""))


def near_words(tokens: DataFrame, knowledge: Knowledge) -> DataFrame:
    """``(text, hit)`` of the tokens (text) that have one: the catalogue word that each is a variant of, or else one of ratio 90 or more that isn't part of it."""
    formed = tokens.select("text").distinct().withColumn("hit", F.nullif(morphological_variant(F.col("text"), knowledge), F.lit("")))
    words = likeness.vocabulary(tokens.sparkSession, sorted(knowledge.approximate_words))
    near = likeness.best(formed.where("hit is null"), words, SETTINGS.approximate_ratio, lambda t, w: ~F.contains(t, w))
    return formed.where("hit is not null").union(near)


def approximate_candidates(tokens: Column, knowledge: Knowledge) -> Column:
    """Tokens that approximate matching may look at."""
    never = [*knowledge.words, *knowledge.never_approximate]
    return F.filter(tokens, lambda t: (F.length(t) >= SETTINGS.morphology_length) & ~T.one_of(t, *never))
