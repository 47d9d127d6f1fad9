"""External validation, offline: priority, cache, batches, budget, cost, answers. The client is the caller's."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.rules import SETTINGS
from ..storage import durable, exists
from .knowledge import division_label
from .resolution import numbered

#: Prices in USD per million tokens (input, output, cached input) and tokens per name.
PRICES, TOKENS_IN, TOKENS_OUT, CHARS_PER_TOKEN, CACHE_WRITE = (5.00, 25.00, 0.50), 12, 55, 3.5, 1.25
ANSWER = "nombre string, nombre_canonico string, seccion string, division string, confianza string, motivo string"


def pending(resolved: DataFrame) -> DataFrame:
    """Unresolved clusters, largest first, with their place from 0."""
    return numbered(resolved.where("seccion = ''").select("cluster", "representante", "n_registros"), "n", 0, F.desc("n_registros"), "cluster")


def not_cached(queue: DataFrame, cache: DataFrame) -> DataFrame:
    return queue.join(cache.select(F.col("nombre").alias("representante")), "representante", "left_anti")


def cached(cache: DataFrame, queue: DataFrame) -> DataFrame:
    return cache.join(queue.select(F.col("representante").alias("nombre")), "nombre", "left_semi")


def batches(queue: DataFrame, size: int = SETTINGS.batch) -> DataFrame:
    return queue.withColumn("lote", F.floor(F.col("n") / size).cast("long"))


def within_budget(queue: DataFrame, calls: int, size: int = SETTINGS.batch) -> DataFrame:
    return batches(queue, size).where(F.col("lote") < calls)


def cost(names: DataFrame, system_chars: int, size: int = SETTINGS.batch) -> DataFrame:
    """One row: calls, tokens and USD for the names (a count column ``nombres``)."""
    price_in, price_out, price_cached = PRICES
    system = float(system_chars // CHARS_PER_TOKEN)
    calls = F.floor((F.col("nombres") + (size - 1)) / size)
    tokens_in = calls * (size * TOKENS_IN) + F.lit(system * CACHE_WRITE)
    cached_in, out = (calls - 1) * F.lit(system), calls * (size * TOKENS_OUT)
    usd = tokens_in / 1e6 * price_in + cached_in / 1e6 * price_cached + out / 1e6 * price_out
    return names.select("nombres", calls.cast("long").alias("llamadas"), F.floor(tokens_in).cast("long").alias("tokens_entrada"), F.floor(cached_in).cast("long").alias("tokens_cache"), out.cast("long").alias("tokens_salida"), F.round(usd, 2).alias("costo_usd"))


def validated(answers: DataFrame) -> DataFrame:
    """Answers with a (section, division) that no catalogue has are blanked, their reason kept."""
    known = F.concat("seccion", "division").isin(*rules.DIVISIONS)
    blank = lambda c: F.when(known, F.col(c)).otherwise(F.lit("")).alias(c)
    return answers.select("nombre", "nombre_canonico", blank("seccion"), blank("division"), F.when(known, F.col("confianza")).otherwise("ninguna").alias("confianza"), "motivo")


def merge(resolved: DataFrame, answers: DataFrame) -> DataFrame:
    """``resolved`` with the answer's sector where there was no evidence; every cluster of a name gets it.

    Of several answers for a name that of least (confidence, section, division) in alphabetical order counts.
    """
    own = answers.where("seccion <> ''").groupBy(F.col("nombre").alias("representante")).agg(F.min(F.struct(F.col("confianza").alias("c"), F.col("seccion").alias("s"), F.col("division").alias("d"))).alias("m")).select("representante", "m.*")
    out = resolved.join(own, "representante", "left")
    take = (F.col("nivel") == "sin_evidencia") & F.col("s").isNotNull()
    columns = [c for c in resolved.columns if c not in ("seccion", "division", "nivel")]
    return out.select(*columns, F.when(take, F.col("s")).otherwise(F.col("seccion")).alias("seccion"), F.when(take, F.col("d")).otherwise(F.col("division")).alias("division"), F.when(take, F.concat(F.lit("llm_"), "c")).otherwise(F.col("nivel")).alias("nivel"))


def asked(queue: DataFrame, client: Callable[[list[str]], str], attempts: int = 3, wait: float = 1.0) -> DataFrame:
    """``(lote, nombres, intentos, respuesta, error)``: the raw answer of an injected client to each batch of ``queue(lote, n, representante)``.

    A call that raises is made again, after ``wait``, twice ``wait`` and so on, at most ``attempts`` times in all; then the
    batch has its error and no answer. A task that is lost calls for its batches again.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for lote, names in zip(frame["lote"], frame["nombres"]):
                names, answer, error, tries = [x or "" for x in names], None, None, 0
                while answer is None and tries < attempts:
                    if tries:
                        time.sleep(wait * 2 ** (tries - 1))
                    tries += 1
                    try:
                        answer, error = str(client(names)), None
                    except Exception as e:  # whatever a caller's client may raise is the batch's own failure
                        error = f"{type(e).__name__}: {e}"
                rows.append((lote, names, tries, answer, error))
            yield pd.DataFrame(rows, columns=["lote", "nombres", "intentos", "respuesta", "error"])

    lists = queue.groupBy("lote").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "representante"))), lambda x: x["representante"]).alias("nombres"))
    return lists.mapInPandas(run, "lote long, nombres array<string>, intentos int, respuesta string, error string")


#: What an answer must be, and each of its items; they are read one by one, so that an odd item costs the others nothing.
RESULTS, ITEM = "resultados array<string>", "n string, nombre_canonico string, seccion string, division string, confianza string, motivo string"


def _results(raw: DataFrame) -> DataFrame:
    return raw.withColumn("_r", F.from_json("respuesta", RESULTS, {"mode": "PERMISSIVE"})["resultados"])


def parsed(raw: DataFrame) -> DataFrame:
    """``(lote, n, nombre, ...)``: the names that raw answers answer, by their number from 1 within the batch.

    Of several items for a number the first counts; other numbers, and items that aren't objects, don't. Malformed answers
    answer nothing.
    """
    items = _results(raw).select("lote", "nombres", F.posexplode("_r").alias("_i", "_x")).withColumn("_x", F.from_json("_x", ITEM, {"mode": "PERMISSIVE"}))
    items = items.withColumn("n", F.when(F.col("_x.n").rlike("^[0-9]{1,9}$"), F.expr("try_cast(_x.n as int)"))).where(F.col("n").between(1, F.size("nombres")))
    first = items.groupBy("lote", "n").agg(F.min_by(F.struct(F.get("nombres", F.col("n") - 1).alias("nombre"), "_x"), "_i").alias("f"))
    text = lambda c: F.coalesce(F.col(f"f._x.{c}"), F.lit("")).alias(c)
    return first.select("lote", "n", "f.nombre", *(text(c) for c in ("nombre_canonico", "seccion", "division", "confianza", "motivo")))


def answer_log(raw: DataFrame) -> DataFrame:
    """``(lote, pedidos, respondidos, intentos, estado)`` of each batch: completa, parcial, malformada or fallida."""
    count = parsed(raw).groupBy("lote").agg(F.count("*").cast("int").alias("respondidos"))
    rows = _results(raw).join(count, "lote", "left").withColumn("pedidos", F.size("nombres")).withColumn("respondidos", F.coalesce("respondidos", F.lit(0)))
    state = F.when(F.col("respuesta").isNull(), "fallida").when(F.col("_r").isNull(), "malformada").when(F.col("respondidos") < F.col("pedidos"), "parcial").otherwise("completa")
    return rows.select("lote", "pedidos", "respondidos", "intentos", state.alias("estado"))


def ask(queue: DataFrame, client: Callable[[list[str]], str], attempts: int = 3, wait: float = 1.0) -> DataFrame:
    """Answers (``ANSWER``) of an injected client to a queue in batches: it takes names and gives ``{"resultados": [{"n": 1, ...}]}``.

    Raw answers are written before they are read, so that each batch is asked for once whatever follows. A failed or
    malformed answer leaves its batch unanswered, for the next run to ask again.
    """
    return parsed(durable(asked(queue, client, attempts, wait), "answers")).drop("lote", "n")


def remember(answers: DataFrame, cache: str, load: str) -> None:
    """Adds the answers (``ANSWER``) of a load to a cache folder; the same load done again takes the place of what it left."""
    answers.select(*_names(ANSWER), F.lit(load).alias("carga")).write.mode("overwrite").parquet(f"{cache}/load-{load}")


def remembered(spark: SparkSession, cache: str) -> DataFrame:
    """The cache's answers, one a name: that of the first load by name, then of least other values. Without a folder none."""
    columns = _names(ANSWER)
    if not exists(spark, cache):
        return spark.createDataFrame([], ANSWER)
    rows = spark.read.schema(f"{ANSWER}, carga string").option("recursiveFileLookup", True).parquet(cache)
    return rows.groupBy("nombre").agg(F.min(F.struct("carga", *columns[1:])).alias("m")).select("nombre", *(f"m.{c}" for c in columns[1:]))


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(",")]


def prompt_catalogue(catalogue) -> list[tuple[str, str, str]]:
    """Distinct (section, division, label) for the prompt, sorted; the last row of a pair decides its label."""
    label = lambda r: getattr(r, "label", None) or rules.DIVISIONS.get(r.section + r.division) or rules.SECTIONS.get(r.section, "")
    found = {(r.section, r.division): label(r) for r in catalogue}
    return [(*pair, text) for pair, text in sorted(found.items())]


def listing(evidence: DataFrame) -> DataFrame:
    """``(seccion, division, etiqueta)``: the pairs that rows with evidence speak of."""
    return evidence.where("seccion <> ''").select("seccion", "division", division_label(F.col("seccion"), F.col("division")).alias("etiqueta")).distinct()


def prompt_text(catalogue) -> str:
    """One line a pair: section, division, label."""
    return "\n".join(" | ".join(row) for row in prompt_catalogue(catalogue))
