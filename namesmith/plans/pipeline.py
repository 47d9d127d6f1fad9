"""The whole flow: names -> records -> nodes -> pairs -> clusters -> canonical name, sector, confidence -> audit rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import text as T
from ..operators import canonical, external, records, resolution, sectors
from ..operators.knowledge import Knowledge, default, division_label, executive_view, macrosector
from ..storage import Stages, durable, ship


class Result(NamedTuple):
    audit: DataFrame
    resolved: DataFrame
    records: DataFrame
    merged: DataFrame
    #: Rows, counters and seconds of each stage that this run computed.
    figures: dict = {}


def run(names: DataFrame, knowledge: Knowledge | None = None, answers: DataFrame | None = None, folder: str | None = None, version: str = "") -> Result:
    """Resolve ``names(idx, nombre_original)``; ``answers`` of external validation are optional.

    With a ``folder``, records, pairs, clusters and what follows from them stay there as named stages, and a later run of
    the same ``version`` (of names and rules) goes on from those that are finished. Answers are merged anew every time.
    """
    ship(names.sparkSession)
    knowledge = knowledge or default()
    stage = Stages(names.sparkSession, folder, version)
    raw = names
    names = stage("names", lambda: raw)
    frequency = stage("frequency", lambda: records.document_frequency(records.first_pass(names, knowledge)))
    kinds = {t.lower(): F.count_if(F.col("tipo") == t) for t in rules.TYPE_LABELS}
    recs = stage("records", lambda: records.records(names, knowledge, frequency)[0], empleadores=F.count_if(T.one_of(F.col("tipo"), *rules.EMPLOYER_TYPES)), truncados=F.count_if("truncado"), **kinds)
    cut = records.generic_cut(names.count())

    node = stage("nodes", lambda: resolution.nodes(recs))
    rare = stage("rare", lambda: resolution.rare_tokens(node, frequency))
    pairs = stage("pairs", lambda: resolution.decide(resolution.candidate_pairs(resolution.signals(rare)), node, rare, cut).where("accepted"))
    merged = stage("merged", lambda: resolution.guarded_clusters(pairs, node, records.generic_tokens(frequency, names.count())))
    member = stage("clusters", lambda: resolution.clusters(merged, node))

    own = stage("members", lambda: resolution.employers(recs).join(member, "clave"))
    best = stage("best", lambda: canonical.best_variant(own, canonical.orthographic_quality(own, frequency)))
    named = canonical.canonical_names(best, canonical.majority_suffix(own, best), knowledge)
    voted = sectors.vote(own, knowledge)
    resolved = named.join(voted, "cluster", "left").withColumn("marcador", sectors.reclassified(F.col("limpio")))
    evidence = sectors.best_token(F.col("tokens"), knowledge)
    resolved = resolved.withColumn("peso", F.coalesce(F.when(F.col("nivel") == "token", knowledge.field(evidence, "weight")), F.lit(5)))
    is_marker = F.col("marcador") != ""
    blank = lambda c, other: F.when(is_marker, F.lit(other)).otherwise(F.coalesce(c, F.lit("" if c != "nivel" else "sin_evidencia"))).alias(c)
    resolved = resolved.select("cluster", F.col("limpio").alias("representante"), "tokens", "truncado", "sufijo_numerico", "clave_generica", "n_registros", "n_claves", "marcador", "nombre_canonico", F.when(is_marker, "reclasificacion_cluster").otherwise(F.col("origen_nombre")).alias("origen_nombre"), blank("seccion", ""), blank("division", ""), blank("nivel", "reclasificacion"), "peso")
    resolved = durable(resolved, "resolved")
    doubts = merged.where("kind = 'doubt'").select("a", "b", "cohesion", "tokens_distintivos")
    heirs = sectors.propagate(resolved, doubts, knowledge).select("cluster", F.col("seccion").alias("s"), F.col("division").alias("d"))
    resolved = resolved.join(heirs, "cluster", "left")
    columns = [c for c in resolved.columns if c not in ("seccion", "division", "nivel", "s", "d")]
    resolved = resolved.select(*columns, F.coalesce("s", "seccion").alias("seccion"), F.coalesce("d", "division").alias("division"), F.when(F.col("s").isNotNull(), "propagacion_duda").otherwise(F.col("nivel")).alias("nivel"))
    if answers is not None:
        resolved = external.merge(resolved, external.validated(answers))
    resolved = durable(canonical.confidence(resolved), "scored")

    fields = resolved.select("cluster", "marcador", "nombre_canonico", "origen_nombre", "seccion", "division", "nivel", "confianza", "banda", "factores")
    employer = own.join(fields, "cluster")
    label = F.when(F.col("marcador") != "", F.lit(rules.NOT_EMPLOYER_LABEL)).otherwise(F.coalesce(division_label(F.col("seccion"), F.col("division")), F.lit(rules.PENDING_LABEL)))
    employer = employer.select(
        "idx", "nombre_original", "limpio", "tokens", "clave", "tipo", "cluster", "stable_id", F.when(F.col("marcador") != "", F.lit(rules.NOT_EMPLOYER_LABEL)).otherwise(F.col("nombre_canonico")).alias("nombre_propuesto"),
        label.alias("sector_propuesto"), "seccion", "division", "confianza", "banda", "origen_nombre", F.col("nivel").alias("origen_sector"), "factores",
    )
    others = non_employers(recs, knowledge)
    audit = employer.unionByName(others)
    audit = audit.withColumn("vista_ejecutiva", executive_view(F.col("seccion"))).withColumn("macrosector", macrosector(F.col("seccion"), F.col("tipo"), F.col("nombre_propuesto")))
    audit = audit.withColumn("traza", F.concat_ws(" | ", F.concat(F.lit("tipo "), "tipo"), F.concat(F.lit("sector por "), "origen_sector"), F.concat_ws("; ", "factores"))).drop("factores")
    return Result(durable(audit, "audit"), resolved, recs, merged, stage.figures)


def non_employers(recs: DataFrame, knowledge: Knowledge) -> DataFrame:
    """Audit rows of records that aren't employers: fixed labels by type, their situation, and a recovered sector."""
    rows = sectors.cascade(recs.where(~T.one_of(F.col("tipo"), *rules.EMPLOYER_TYPES)), knowledge)
    field = lambda i: F.element_at(F.create_map(*[x for k, v in rules.TYPE_LABELS.items() for x in (F.lit(k), F.lit(v[i]))]), F.col("tipo"))
    said = records.situation(F.col("limpio"), F.col("tokens"))
    name = F.when(F.col("tipo").isin("INACTIVO", "ANOTACION") & (said != ""), said).otherwise(field(0))
    kept = T.one_of(F.col("tipo"), *rules.SECTOR_KEEPERS) & (F.col("seccion") != "")
    only = lambda c: F.when(kept, F.col(c)).otherwise(F.lit("")).alias(c)
    none = F.lit(None).cast("string")
    return rows.select(
        "idx", "nombre_original", "limpio", "tokens", "clave", "tipo", none.alias("cluster"), none.alias("stable_id"), name.alias("nombre_propuesto"),
        F.when(kept, division_label(F.col("seccion"), F.col("division"))).otherwise(field(1)).alias("sector_propuesto"), only("seccion"), only("division"),
        field(2).cast("int").alias("confianza"), canonical.band(field(2)).alias("banda"), F.lit("tipo").alias("origen_nombre"), F.when(kept, F.col("nivel")).otherwise(F.lit("tipo")).alias("origen_sector"), F.array(F.lit("tipo resuelto con certeza")).alias("factores"),
    )


def deliverable(audit: DataFrame) -> DataFrame:
    """The four delivered columns; names in capitals there only."""
    return audit.select("nombre_original", F.upper("nombre_propuesto").alias("nombre_propuesto"), "sector_propuesto", "macrosector")
