"""Profiling, quality indicators, concentration, review lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import text as T
from .knowledge import executive_view


def profile(names: DataFrame) -> DataFrame:
    """``(patron, n)``: how many names match each profiling pattern, in one pass."""
    base = T.strip_export_prefix(F.col("nombre_original"))
    tests = [(name, base.rlike(p)) for name, p in rules.PROFILE_PATTERNS] + [("LEN<=3", F.length(base) <= 3), ("APOSTROFO", F.trim("nombre_original").startswith("'")), ("TILDES", base.rlike("[ÁÉÍÓÚÑÜáéíóúñü]")), ("MINUSCULAS", base != F.upper(base)), ("PANAMEA", F.contains(base, F.lit("PANAMEA")))]
    one = names.where("nombre_original is not null").agg(*[F.count_if(t).alias(n) for n, t in tests])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("patron"), F.col(f"`{n}`").alias("n")) for n, _ in tests])).alias("x")).select("x.*")


def uniqueness(names: DataFrame) -> DataFrame:
    """One row: names, distinct names, those with a trailing number, distinct and repeated without it."""
    base = names.where("nombre_original is not null").select(T.strip_export_prefix(F.col("nombre_original")).alias("b"))
    cut = base.withColumn("c", F.regexp_replace("b", "\\s+[0-9]+$", ""))
    groups = cut.groupBy("c").agg(F.count("*").alias("n"), F.count_if(F.col("b") != F.col("c")).alias("numbered"), F.countDistinct("b").alias("d"))
    return groups.agg(F.sum("n").alias("nombres"), F.sum("numbered").alias("con_numero"), F.count("*").alias("distintos_sin_numero"), F.count_if(F.col("n") > 1).alias("repetidos"))


def length_histogram(names: DataFrame, low: int = 26, high: int = 42) -> DataFrame:
    length = F.length(T.strip_export_prefix(F.col("nombre_original")))
    return names.select(length.cast("int").alias("largo")).where(F.col("largo").between(low, high)).groupBy("largo").agg(F.count("*").alias("n"))


def char_histogram(names: DataFrame) -> DataFrame:
    chars = F.explode(F.split(T.strip_export_prefix(F.col("nombre_original")), ""))
    return names.select(chars.alias("caracter")).where("caracter <> ''").groupBy("caracter").agg(F.count("*").alias("n"))


def concentration(sections: DataFrame) -> DataFrame:
    """``(sector_ejecutivo, registros, porcentaje)`` of a column ``seccion``."""
    counts = sections.where("seccion <> ''").groupBy(executive_view(F.col("seccion")).alias("sector_ejecutivo")).agg(F.count("*").alias("registros"))
    total = counts.agg(F.sum("registros").alias("total"))
    return counts.join(total).select("sector_ejecutivo", "registros", F.round(100.0 * F.col("registros") / F.col("total"), 4).alias("porcentaje"))


#: Values that are ordered at once at the end of a selection.
FEW = 50_000


def upper_median(df: DataFrame, column: str, few: int = FEW) -> DataFrame:
    """One row: the element at place n div 2 of the sorted values, exactly; null without values (nulls and NaN aren't).

    Selection in rounds: a sketch gives two values that likely enclose the place, an aggregate counts what lies below, at and
    between them, and the next round sees what is strictly between (or outside, where the sketch was wrong), so every
    round leaves out at least two values and mostly all but a ten-thousandth. The last ``few`` values are counted and ordered.
    """
    spark, kind = df.sparkSession, df.schema[column].dataType.simpleString()
    values = df.select(F.col(column).alias("v")).where("v is not null")
    if kind in ("float", "double"):
        values = values.where(~F.isnan("v"))
    n = values.count()
    place, below, inside, found = n // 2, 0, n, None
    while inside > few and found is None:
        q = (place - below + 0.5) / inside
        low, high = values.agg(F.percentile_approx("v", [max(0.0, q - 2e-4), min(1.0, q + 2e-4)], 10000)).first()[0]
        low_, high_ = F.lit(low).cast(kind), F.lit(high).cast(kind)
        parts = (F.col("v") < low_, F.col("v") == low_, (F.col("v") > low_) & (F.col("v") < high_), (F.col("v") == high_) & (high_ > low_), F.col("v") > high_)
        counts = values.agg(*(F.count_if(p) for p in parts)).first()
        for k, (count, part) in enumerate(zip(counts, parts)):
            if place < below + count:
                inside = count
                found = (low, high)[k == 3] if k in (1, 3) else None
                values = values.where(part)
                break
            below += count
    if found is None:
        for value, count in values.groupBy("v").agg(F.count("*")).orderBy("v").collect():  # few at most
            found = value if found is None and place < below + count else found
            below += count
    return spark.createDataFrame([(found,)], f"mediana {kind}")


def counters(df: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """``(dimension, valor, n, porcentaje)``: how many rows have each value of each dimension, and all of them (total), in one pass."""
    names = {f"_{k}": name for k, name in enumerate(dimensions)}
    rows = df.select(*(c.cast("string").alias(own) for own, c in zip(names, dimensions.values())))
    out = rows.groupingSets([[F.col(own)] for own in names] + [[]], *(F.col(own) for own in names)).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    every = (1 << len(names)) - 1
    label, value = F.when(F.col("g") == every, "total"), F.lit(None).cast("string")
    for k, (own, name) in enumerate(names.items()):
        here = F.col("g") == every - (1 << len(names) - 1 - k)
        label, value = label.when(here, name), F.when(here, F.col(own)).otherwise(value)
    # One row for each value of a label: few, whatever the input.
    share = F.round(100.0 * F.col("n") / F.max(F.when(F.col("g") == every, F.col("n"))).over(Window.partitionBy()), 4)
    return out.select(label.alias("dimension"), value.alias("valor"), "n", share.alias("porcentaje"))


def kpis(rows: DataFrame) -> DataFrame:
    """One row of quality indicators over ``(tipo, cluster, seccion, confianza, banda)``."""
    employer = T.one_of(F.col("tipo"), *rules.EMPLOYER_TYPES)
    sector = F.coalesce("seccion", F.lit("")) != ""
    share = lambda a, b: F.bround(100.0 * a / b, 2)
    one = rows.agg(
        F.count("*").alias("registros"), F.count_if(employer).alias("empleadores"), F.countDistinct(F.when(employer, F.col("cluster"))).alias("empleadores_unicos"),
        F.count_if(sector).alias("con_sector"), F.count_if(sector & employer).alias("con_sector_empleador"), F.avg("confianza").alias("media"),
        *[F.count_if(F.col("banda") == b).alias(f"banda_{b}") for b in (*(name for _, name in rules.BANDS), "verificacion_individual")],
    )
    return one.select(
        "registros", "empleadores", "empleadores_unicos", "con_sector", share(F.col("empleadores"), F.col("registros")).alias("pct_empleadores"),
        share(F.col("empleadores") - F.col("empleadores_unicos"), F.col("empleadores")).alias("pct_consolidacion"),
        share(F.col("con_sector"), F.col("empleadores")).alias("cobertura_publicada"), share(F.col("con_sector_empleador"), F.col("empleadores")).alias("cobertura_empleadores"),
        F.bround("media", 1).alias("confianza_media"), *[c for c in one.columns if c.startswith("banda_")],
    )


def review_block(kind: Column, name: Column) -> Column:
    return F.when(T.one_of(kind, *rules.EMPLOYER_TYPES), "empleador sin sector").when(name.startswith(rules.UNIDENTIFIED), "no identificable").otherwise("situacion laboral")


def review_backlog(rows: DataFrame) -> DataFrame:
    """``(bloque, idx, nombre_original, nombre_propuesto, tipo)`` of what has no sector or isn't an employer."""
    open_ = rows.where((F.coalesce("seccion", F.lit("")) == "") | ~T.one_of(F.col("tipo"), *rules.EMPLOYER_TYPES))
    return open_.select(review_block(F.col("tipo"), F.col("nombre_propuesto")).alias("bloque"), "idx", "nombre_original", "nombre_propuesto", "tipo")


REVIEW_BLOCKS = ("no identificable", "situacion laboral", "empleador sin sector")


def vocabulary_pivot(backlog: DataFrame) -> DataFrame:
    """Word by review block: in how many records it occurs. ``backlog``: (bloque, tokens)."""
    words = backlog.select("bloque", F.explode(F.array_distinct("tokens")).alias("palabra"))
    out = words.groupBy("palabra").pivot("bloque", list(REVIEW_BLOCKS)).count()
    counts = [F.coalesce(F.col(f"`{b}`"), F.lit(0)).cast("long").alias(b.replace(" ", "_")) for b in REVIEW_BLOCKS]
    out = out.select("palabra", *counts)
    return out.withColumn("total", sum(F.col(b.replace(" ", "_")) for b in REVIEW_BLOCKS))


def top_n(df: DataFrame, column: str, n: int, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(column), *ties).limit(n)


def master(rows: DataFrame) -> DataFrame:
    """One row a cluster: that of its first record, with counts of records and distinct keys."""
    others = [c for c in rows.columns if c not in ("cluster", "idx")]
    first = rows.groupBy("cluster").agg(F.min_by(F.struct(*others), F.col("idx")).alias("f"), F.count("*").alias("registros"), F.countDistinct("clave").alias("variantes"))
    return first.select("cluster", "registros", "variantes", "f.*")


def review_list(backlog: DataFrame) -> DataFrame:
    """The backlog with its place in alphabetical order within blocks, where families of names stand together."""
    from .resolution import numbered

    return numbered(backlog.withColumn("nombre", T.strip_export_prefix(F.col("nombre_original"))), "orden", 1, "bloque", "nombre", "idx")


def samples(names: DataFrame, seed: int = 2026, sizes: tuple[int, int, int] = (30, 15, 20)) -> DataFrame:
    """``(muestra, puesto, idx, nombre)``: seeded samples of all names, of cut-off ones and of short ones: those of least hash."""
    base = names.select("idx", T.strip_export_prefix(F.col("nombre_original")).alias("nombre"), F.md5(F.concat(F.lit(f"{seed}:"), F.col("idx").cast("string"))).alias("h"))
    universes = (("general", F.lit(True)), ("truncados", F.length("nombre") == 30), ("cortos", F.length("nombre") <= 6))
    out = None
    for (label, holds), k in zip(universes, sizes):
        least = base.where(holds).orderBy("h", "idx").limit(k)  # a bounded top list
        placed = least.groupBy().agg(F.array_sort(F.collect_list(F.struct("h", "idx", "nombre"))).alias("x")).select(F.posexplode("x").alias("p", "r"))
        part = placed.select(F.lit(label).alias("muestra"), (F.col("p") + 1).cast("int").alias("puesto"), "r.idx", "r.nombre")
        out = part if out is None else out.union(part)
    return out
