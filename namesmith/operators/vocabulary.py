"""Sector evidence from knowledge that is a table: catalogue and gazetteer of any size, met by equi-joins.

``sectors`` writes its knowledge into expressions, which suits some hundred keys. Here no key reaches a plan or the driver:
distinct cores are the dimension, and what they hold (words, runs of words, letter groups) meets the tables by value. Small
tables are broadcast where Spark's own size check says so; otherwise both sides are shuffled, frequent values dealt over
``SALTS`` tasks. The results are those of ``sectors.cascade`` for the same knowledge, but for equally long phrases.

Tables: catalogue (key, section, division, weight) and gazetteer (key, name, section, division), with a column ``orden`` or
without. Keys are cleaned as names are; null and empty ones count for nothing. Of a key's rows the one of greatest orden,
then weight, section and division (or name) counts. Empty tables give no evidence. Null cores have none.
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
from .records import horizontal_property

#: Parts that a frequent value is dealt over; letters of the groups that phrases are found by; words of a gazetteer run.
SALTS, GRAM, RUN = 16, 4, 5


def tables(spark, knowledge: Knowledge) -> tuple[DataFrame, DataFrame]:
    """The rows of a ``Knowledge`` as tables."""
    one = [(n, r.key, r.section, r.division, r.weight) for n, r in enumerate(knowledge.catalogue)]
    two = [(n, r.key, r.name, r.section, r.division) for n, r in enumerate(knowledge.gazetteer)]
    return spark.createDataFrame(one, "orden int, key string, section string, division string, weight int"), spark.createDataFrame(two, "orden int, key string, name string, section string, division string")


def _last(df: DataFrame, key: Column, *fields: str) -> DataFrame:
    """One row a key that isn't empty."""
    order = F.col("orden") if "orden" in df.columns else F.lit(0)
    rows = df.select(key.alias("key"), F.struct(order.alias("o"), *fields).alias("v")).where("key <> ''")
    return rows.groupBy("key").agg(F.max("v").alias("v")).select("key", *(f"v.{f}" for f in fields))


def catalogue_table(df: DataFrame) -> DataFrame:
    """``(key, weight, section, division)``, keys distinct."""
    return _last(df, T.clean_base(F.col("key")), "weight", "section", "division")


def gazetteer_table(df: DataFrame) -> DataFrame:
    """``(key, section, division, name)``: keys with the abbreviations written out and without stopwords, as names have them."""
    tokens = F.flatten(F.transform(T.tokens_of(T.clean_base(F.col("key"))), lambda t: F.split(T.lookup(t, rules.ABBREVIATIONS, t), " ")))
    return _last(df, T.text_of(T.without(tokens, rules.STOPWORDS)), "section", "division", "name")


def met(many: DataFrame, table: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """``many`` joined with ``table``, whose keys are distinct or few; rows of a frequent key go to ``SALTS`` tasks by a hash of ``by``."""
    left = many.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    right = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def _letters(c: Column, n) -> Column:
    """Groups of ``n`` neighbouring letters."""
    n = F.lit(n) if isinstance(n, int) else n
    none = F.array().cast("array<string>")
    return F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, n))).otherwise(none)


def longest_phrase(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """``(text, phrase, ...)`` of the distinct ``texts(text)`` that hold a phrase: the longest, then the earliest in the text.

    A phrase is looked for only in texts that hold its rarest group of ``GRAM`` letters (all of it, if shorter), by the
    counts of these texts; one of whose groups none of them has is in none. ``phrases``: (phrase, ...), distinct.
    """
    column = F.col("phrase")
    listed = phrases.where("phrase <> ''").withColumn("_n", F.least(F.length(column), F.lit(GRAM)))
    sizes = sorted(r[0] for r in listed.select("_n").distinct().collect())  # at most GRAM numbers
    held = texts.where("text is not null").select("text", F.explode(F.array_distinct(F.concat(F.array().cast("array<string>"), *(_letters(F.col("text"), n) for n in sizes)))).alias("gram"))
    asked = listed.select("phrase", F.explode(F.array_distinct(_letters(column, F.col("_n")))).alias("gram"))
    count = held.groupBy("gram").agg(F.count("*").alias("n"))
    anchors = asked.join(count, "gram", "left").groupBy("phrase").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("a")).where("a.n > 0")
    rows = met(held, listed.drop("_n").join(anchors.select("phrase", F.col("a.gram").alias("gram")), "phrase"), "gram", "text").where(F.contains("text", column))
    best = rows.groupBy("text").agg(F.max_by(F.struct(*phrases.columns), F.struct(F.length(column), -F.expr("instr(text, phrase)"))).alias("b"))
    return best.select("text", "b.*")


def known_employer(texts: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """``(text, key, section, division)`` of texts that name an employer: by all their words, or else the leftmost, then longest run."""
    kept = texts.select("text", T.without(F.split("text", " "), rules.STOPWORDS).alias("w")).where(F.size("w") > 0)
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(RUN), F.size("w") - i + 1)), lambda n: F.struct(i.alias("i"), (-n).alias("n"), T.text_of(F.slice("w", i, n)).alias("key")))))
    whole = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("n"), T.text_of(F.col("w")).alias("key")))
    found = met(kept.select("text", F.inline(F.concat(whole, runs))), gazetteer.select("key", "section", "division"), "key", "text")
    return found.groupBy("text").agg(F.min(F.struct("i", "n", "key", "section", "division")).alias("b")).select("text", "b.key", "b.section", "b.division")


def near_words(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """``(text, word, section, division)`` of the distinct tokens (text) that are a plural or singular of a word, or else nearly one.

    Of the words of equal ratio the alphabetically first counts. ``words``: (key, weight, section, division).
    """
    strong = words.where(F.col("weight") >= SETTINGS.approximate_weight).select(F.col("key").alias("word"), "section", "division")
    t = F.col("text")
    cut = lambda end: F.when(t.endswith(end), F.substring(t, F.lit(1), F.length(t) - len(end)))
    forms = tokens.select("text", F.posexplode(F.array(F.concat(t, F.lit("S")), F.concat(t, F.lit("ES")), cut("S"), cut("ES"))).alias("i", "word"))
    best = lambda rows, first: rows.groupBy("text").agg(F.min(F.struct(first, "word", "section", "division")).alias("b")).select("text", "b.word", "b.section", "b.division")
    formed = durable(best(forms.join(strong, "word"), F.col("i")), "variants")
    long = strong.where(F.length("word") >= SETTINGS.approximate_length)
    near = likeness.similar(tokens.join(formed, "text", "left_anti"), long, SETTINGS.approximate_ratio, lambda a, w: ~F.contains(a, w))
    return formed.unionByName(best(near, (-F.col("ratio")).alias("r")))


def token_evidence(texts: DataFrame, words: DataFrame) -> DataFrame:
    """``(text, token, prefix, near)`` as structs, null where there is none: the word of most weight (the earliest of equals),
    the first trade prefix of a word that the catalogue lacks, the first word that is nearly one of the catalogue's."""
    listed = texts.where("text <> ''").select("text", F.posexplode(F.split("text", " ")).alias("i", "key"))
    seen = durable(met(listed, words, "key", "text", "left"), "words")
    unknown = F.col("weight").isNull()
    prefix = F.lit(None).cast("string")
    for p, *_ in reversed(rules.COMMERCIAL_PREFIXES):
        prefix = F.when(F.col("key").startswith(p) & (F.length("key") >= len(p) + SETTINGS.prefix_extra), F.lit(p)).otherwise(prefix)
    seen = seen.withColumn("p", F.when(unknown, prefix))
    own = seen.groupBy("text").agg(
        F.max(F.when(~unknown, F.struct("weight", (-F.col("i")).alias("i"), "key", "section", "division"))).alias("token"),
        F.min(F.when(F.col("p").isNotNull(), F.struct("i", "p"))).alias("prefix"),
    )
    never = sorted({*rules.GIVEN_NAMES, *rules.SURNAMES, *rules.PLACE_TOKENS, *rules.NOT_APPROXIMATE})
    able = seen.where(unknown & (F.length("key") >= SETTINGS.morphology_length) & ~T.one_of(F.col("key"), *never)).select("text", "i", "key")
    hits = durable(near_words(able.select(F.col("key").alias("text")).distinct(), words), "near")
    near = met(able, hits.withColumnRenamed("text", "key"), "key", "text").groupBy("text").agg(F.min(F.struct("i", "word", "section", "division")).alias("near"))
    return own.join(near, "text", "left")


def cascade(df: DataFrame, catalogue: DataFrame, gazetteer: DataFrame, by: str = "idx") -> DataFrame:
    """Adds ``nivel, evidencia, seccion, division, peso`` to ``(nucleo, tokens, sufijo_societario)``: the strongest evidence.

    ``tokens`` are the words of ``nucleo``. Rows of one core are dealt by ``by``, a column that tells them apart.
    """
    out = ["nivel", "evidencia", "seccion", "division", "peso"]
    df = durable(df.drop(*out), "cores")
    keys, employers = durable(catalogue_table(catalogue), "catalogue"), durable(gazetteer_table(gazetteer), "gazetteer")
    texts = durable(df.select(F.col("nucleo").alias("text")).where("text is not null").distinct(), "texts")
    many = F.contains("key", F.lit(" "))
    phrases = longest_phrase(texts, keys.where(many).select(F.col("key").alias("phrase"), "section", "division"))
    tokens = token_evidence(texts, keys.where(~many))

    def found(level, key, section, division, weight=None):
        weight = F.lit(5) if weight is None else weight
        columns = [F.lit(level) if isinstance(level, str) else level, key, section, division, weight.cast("int")]
        return F.struct(*(c.alias(n) for c, n in zip(columns, out)))

    def given(level, source, key, weight=None):
        c = lambda name: F.col(f"{source}.{name}")
        return F.when(F.col(source).isNotNull(), found(level, c(key), c("section"), c("division"), weight))

    employer = known_employer(texts, employers).select("text", F.struct("key", "section", "division").alias("employer"))
    phrase = phrases.select("text", F.struct("phrase", "section", "division").alias("frase"))
    sector = lambda i: F.element_at(T.constant_map({r[0]: r[i] for r in rules.COMMERCIAL_PREFIXES}), F.col("prefix.p"))
    rows = texts.join(employer, "text", "left").join(phrase, "text", "left").join(tokens, "text", "left")
    trade = F.when(F.col("prefix").isNotNull(), found("prefijo_comercial", F.col("prefix.p"), sector(1), sector(2)))
    later = F.coalesce(given("frase", "frase", "phrase"), given("token", "token", "key", F.col("token.weight")), trade, given("token_aproximado", "near", "word"))
    dimension = rows.select(F.col("text").alias("nucleo"), given("gazetteer", "employer", "key").alias("_first"), later.alias("_later"))
    building = F.when(horizontal_property(F.col("tokens"), F.col("sufijo_societario")), found("propiedad_horizontal", F.lit("PH"), F.lit("L"), F.lit("68")))
    none = found("sin_evidencia", F.lit(""), F.lit(""), F.lit(""))
    joined = met(df, durable(dimension, "evidence"), "nucleo", by, "left")
    return joined.select(*df.columns, F.coalesce("_first", building, "_later", none).alias("_e")).select(*df.columns, "_e.*")
