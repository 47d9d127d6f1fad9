"""Canonical name of a cluster, and the confidence of each decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import text as T
from .knowledge import Knowledge, mapped
from .records import gazetteer_key


def bit_length(n: Column) -> Column:
    return F.when(n > 0, F.length(F.bin(n))).otherwise(0)


def orthographic_quality(records: DataFrame, frequency: DataFrame, key: str = "idx") -> DataFrame:
    """``(key, calidad)``: bits of the least frequency among the tokens of four letters or more; 0 without one."""
    tokens = records.select(key, F.explode_outer(F.filter(F.array_distinct("tokens"), lambda t: F.length(t) >= 4)).alias("token"))
    measured = tokens.join(frequency, "token", "left").groupBy(key).agg(F.min(F.when(F.col("token").isNotNull(), F.coalesce("df", F.lit(1)))).alias("least"))
    return measured.select(key, F.coalesce(bit_length(F.col("least")), F.lit(0)).cast("int").alias("calidad"))


def best_variant(records: DataFrame, quality: DataFrame, cluster: str = "cluster") -> DataFrame:
    """One row for each cluster, its best record: whole, well spelt, many words, with legal form, long, last in order."""
    score = F.struct(
        F.when(F.col("truncado"), 0).otherwise(1).alias("entero"), F.col("calidad"), F.size("tokens").alias("palabras"), F.when(F.col("sufijo_societario") != "", 1).otherwise(0).alias("forma"),
        F.length("limpio").alias("largo"), F.col("limpio"), F.col("nucleo"), F.col("sufijo_societario"), F.col("truncado"), F.col("tokens"), F.col("sufijo_numerico"), F.col("clave_generica"), F.col("tipo"),
    )
    grouped = records.join(quality, "idx").groupBy(F.col(cluster).alias("cluster")).agg(F.max(score).alias("m"), F.count("*").alias("n_registros"), F.countDistinct("clave").alias("n_claves"))
    return grouped.select("cluster", "m.limpio", "m.nucleo", "m.tokens", "m.truncado", "m.sufijo_numerico", "m.clave_generica", "m.tipo", F.col("m.sufijo_societario").alias("forma_propia"), "n_registros", "n_claves")


def majority_suffix(records: DataFrame, best: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``(cluster, sufijo)``: the most frequent legal form if at least half of the records have it and the name isn't public.

    Ties go to the form of the earliest record.
    """
    counts = records.where("sufijo_societario <> ''").groupBy(F.col(cluster).alias("cluster"), "sufijo_societario").agg(F.count("*").alias("n"), F.min("idx").alias("first"))
    top = counts.groupBy("cluster").agg(F.max(F.struct("n", (-F.col("first")).alias("first"), F.col("sufijo_societario").alias("s"))).alias("m"))
    out = best.join(top, "cluster", "left")
    public = F.get(F.split("nucleo", " "), F.lit(0)).isin(*rules.PUBLIC_HEADS)
    return out.select("cluster", F.when(~public & (2 * F.col("m.n") >= F.col("n_registros")), F.col("m.s")).otherwise(F.lit("")).alias("sufijo"))


def canonical_names(best: DataFrame, suffix: DataFrame, knowledge: Knowledge) -> DataFrame:
    """Adds ``nombre_canonico, origen_nombre``: the known employer, or else the rebuilt name with its legal form."""
    hit = gazetteer_key(F.col("tokens"), knowledge)
    form = F.coalesce(F.when(T.one_of(F.col("sufijo"), *rules.LEGAL_FORM), mapped(F.col("sufijo"), rules.LEGAL_FORM)), F.col("sufijo"))
    built = F.concat(T.title_case_es(F.col("nucleo")), F.when(F.col("sufijo") != "", F.concat(F.lit(", "), form)).otherwise(F.lit("")))
    out = best.join(suffix, "cluster").withColumn("_hit", hit)
    return out.select("*", F.coalesce(knowledge.employer(F.col("_hit"), "name"), built).alias("nombre_canonico"), F.when(F.col("_hit").isNotNull(), "gazetteer").otherwise("reconstruccion").alias("origen_nombre")).drop("_hit")


def confidence(df: DataFrame) -> DataFrame:
    """Adds ``confianza, banda, factores`` to ``(origen_nombre, nivel, peso, truncado, n_claves, tokens, clave_generica, sufijo_numerico)``."""
    constant = lambda c, table, other: F.coalesce(F.when(F.col(c).isin(*table), F.element_at(T.constant_map(table), F.col(c)).cast("double")), F.lit(other))
    identity = constant("origen_nombre", rules.IDENTITY_FACTOR, 0.70)
    sector = F.when(F.col("nivel") == "token", F.lit(0.55) + F.lit(0.05) * F.least("peso", F.lit(9))).otherwise(constant("nivel", rules.SECTOR_FACTOR, 0.50))
    n, size = F.col("n_claves"), F.size("tokens")
    changes = [
        ("truncado en origen y sin variante completa", F.col("truncado") & (n == 1), F.lit(-12)),
        ("nombre de una palabra", size == 1, F.lit(-6)),
        ("solo iniciales", (size > 0) & F.forall("tokens", lambda t: F.length(t) <= 2), F.lit(-10)),
        ("nombre generico con numero", F.col("clave_generica") & (F.col("sufijo_numerico") != ""), F.lit(-8)),
        ("grupo grande sin ancla", (n >= 12) & ~F.col("origen_nombre").isin("gazetteer", "reclasificacion_cluster"), F.lit(-10)),
        ("variantes coherentes", n.between(2, 11), F.least(F.lit(6), n).cast("int")),
    ]
    score = F.lit(100.0) * identity * sector
    for _, holds, points in changes:
        score = score + F.when(holds, points).otherwise(F.lit(0)).cast("double")
    score = F.bround(F.greatest(F.lit(0.0), F.least(F.lit(100.0), score))).cast("int")
    factors = F.filter(
        F.array(
            F.format_string("identidad %s (x%.2f)", F.col("origen_nombre"), identity), F.format_string("sector %s (x%.2f)", F.col("nivel"), sector),
            *[F.when(holds, F.concat(F.when(points > 0, "+").otherwise(""), points.cast("string"), F.lit(f" {why}"))) for why, holds, points in changes],
        ),
        lambda f: f.isNotNull(),
    )
    return df.select("*", score.alias("confianza"), factors.alias("factores")).withColumn("banda", band(F.col("confianza")))


def band(score: Column) -> Column:
    out = None
    for least, name in rules.BANDS:
        out = F.when(score >= least, name) if out is None else out.when(score >= least, name)
    return out.otherwise("verificacion_individual")
