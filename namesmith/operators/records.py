"""Cleaned records: from raw names to tokens, legal form, number, comparison key and record type.

``records`` makes both passes: the first measures document frequencies, from which generic tokens and the corpus-derived
joins of split words follow; the second applies them. Both passes are projections, but for corrections of single words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import text as T
from ..functions.rules import SETTINGS
from ..storage import durable
from .knowledge import Knowledge, default
from .lexicon import typo_correction


def base_words(names: DataFrame) -> DataFrame:
    """Adds ``palabras``, the words before any joins, to ``(idx, nombre_original)``."""
    base = names.select("idx", "nombre_original", T.repair_split_words(T.clean_base(F.col("nombre_original"))).alias("_base"))
    return base.select("idx", "nombre_original", T.tokens_of(F.col("_base")).alias("palabras"))


def cleaned(words: DataFrame, knowledge: Knowledge) -> DataFrame:
    """``(idx, nombre_original, palabras)`` with cleaned tokens, from words that may have been joined.

    Every step is a column of its own: an expression that is read twice would be computed twice.
    """
    rows = words.withColumn("palabras", T.join_spelled_acronyms(T.text_of(F.col("palabras")))).withColumn("palabras", T.tokens_of(F.col("palabras")))
    rows = rows.withColumn("palabras", T.complete_truncated_stem(T.split_glued_suffix(F.col("palabras"), list(knowledge.words))))
    return typo_correction(rows, knowledge)


def _phrase(text: Column, markers) -> Column:
    """Equality with a marker, or a marker of several words within the text."""
    many = [m for m in markers if " " in m]
    within = [F.contains(text, F.lit(m)) for m in many]
    out = T.one_of(text, *markers)
    for w in within:
        out = out | w
    return out


def _loose(tokens: Column, markers) -> Column:
    single = [m for m in markers if " " not in m]
    return F.exists(tokens, lambda t: T.one_of(t, *single))


def unclassifiable(text: Column) -> Column:
    """All digits, or one character repeated."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    return plain.rlike("^[0-9]+$") | (F.length(plain) >= 2) & (F.replace(plain, F.substring(plain, 1, 1), F.lit("")) == "")


def situation(text: Column, tokens: Column) -> Column:
    """The declared situation ('' if none), groups in their order."""
    out = None
    for label, markers in rules.SITUATIONS:
        many = [m for m in markers if " " in m]
        hit = _loose(tokens, markers)
        for m in many:
            hit = hit | F.contains(text, F.lit(m))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.when(text.startswith(rules.ANNOTATION_PREFIX), F.lit(rules.PREFIX_SITUATION)).otherwise(F.lit(""))


def horizontal_property(tokens: Column, suffix: Column) -> Column:
    """A condominium as an employer: PH among the first two words, no legal form, unit or street word."""
    return F.array_contains(F.slice(tokens, 1, 2), "PH") & (suffix == "") & ~F.exists(tokens, lambda t: T.one_of(t, *rules.UNIT_TOKENS, *rules.STRONG_ADDRESS))


def gazetteer_key(tokens: Column, knowledge: Knowledge) -> Column:
    """The known employer in a name: all its tokens, or else the leftmost, then longest run of up to five (null if none)."""
    kept = T.without(tokens, rules.STOPWORDS)
    keys = list(knowledge.employers)
    whole = T.text_of(kept)
    longest = max(len(k.split()) for k in keys)
    sizes = F.array(*[F.lit(n) for n in range(min(5, longest), 0, -1)])
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(F.size(kept), F.lit(1))), lambda i: F.transform(F.filter(sizes, lambda n: i + n - 1 <= F.size(kept)), lambda n: T.text_of(F.slice(kept, i, n)))))
    return F.when(T.one_of(whole, *keys), whole).otherwise(F.get(F.filter(runs, lambda r: T.one_of(r, *keys)), F.lit(0)))


def record_type(text: Column, tokens: Column, suffix: Column, knowledge: Knowledge) -> Column:
    """The first type of the decision list that holds. ``text``: cleaned, with legal form, without number."""
    strong = [k for k, r in knowledge.words.items() if r.weight >= SETTINGS.strong_weight]
    plain = F.replace(text, F.lit(" "), F.lit(""))
    # 1-based places of the first strong business word, address word and student; 0 if there is none.
    place = lambda words: F.coalesce(F.array_min(F.filter(F.transform(tokens, lambda t, i: F.when(T.one_of(t, *words), i + 1)), lambda x: x.isNotNull())), F.lit(0))
    business, address, student = place(strong), place([*rules.STRONG_ADDRESS, *rules.WEAK_ADDRESS]), place(["ESTUDIANTE"])
    empty = (F.length(text) <= 1) | plain.rlike("^[X0]+$") | T.one_of(text, *rules.NULL_MARKERS) | unclassifiable(text)
    annotation = _phrase(text, rules.ANNOTATIONS) | text.startswith(rules.ANNOTATION_PREFIX)
    only_student = ~_phrase(text, [m for m in rules.INACTIVE if m != "ESTUDIANTE"]) & ~_loose(tokens, [m for m in rules.INACTIVE if m != "ESTUDIANTE"]) & (student > 0)
    inactive = (_phrase(text, rules.INACTIVE) | _loose(tokens, rules.INACTIVE)) & ~(only_student & (business > 0) & (business < student))
    independent = _phrase(text, rules.INDEPENDENT) | _loose(tokens, rules.INDEPENDENT)
    weak = F.size(F.array_distinct(F.filter(tokens, lambda t: T.one_of(t, *rules.WEAK_ADDRESS) & ~((t == "CASA") & text.rlike(rules.HOUSE_OF)))))
    near = text.rlike(rules.ADDRESS_NUMBER) | F.get(tokens, F.lit(0)).isin(*[p.split()[0] for p in rules.PLACES]) | F.exists(tokens, lambda t: T.one_of(t, *rules.PLACE_TOKENS))
    guard = (suffix == "") & ~horizontal_property(tokens, suffix) & gazetteer_key(tokens, knowledge).isNull() & ~((business > 0) & ((address == 0) | (business < address)))
    street = F.exists(tokens, lambda t: T.one_of(t, *rules.STRONG_ADDRESS)) | (weak >= 1) & ((weak >= 2) | near)
    jobs = (F.size(tokens) > 0) & F.forall(tokens, lambda t: T.one_of(t, *rules.OCCUPATIONS, *rules.STOPWORDS))
    surnames = F.size(F.filter(tokens, lambda t: T.one_of(t, *rules.SURNAMES)))
    person = F.size(tokens).between(2, 4) & (suffix == "") & (F.exists(tokens, lambda t: T.one_of(t, *rules.GIVEN_NAMES)) & (surnames > 0) | (surnames >= 2))
    return (
        F.when(empty, "VACIO").when(annotation, "ANOTACION").when(_phrase(text, rules.WAITING), "INACTIVO").when(inactive, "INACTIVO")
        .when(independent, "INDEPENDIENTE").when(guard & street, "DIRECCION").when(jobs, "OCUPACION").when(person, "PERSONA_NATURAL").otherwise("EMPRESA")
    )


def parts(tokens: DataFrame) -> DataFrame:
    """From ``(idx, nombre_original, palabras)`` to the record's parts; no key or type yet."""
    text = tokens.withColumn("limpio", T.text_of(F.col("palabras"))).withColumn("truncado", T.is_truncated(F.col("limpio")))
    rest, number = T.split_number(F.col("limpio"))
    text = text.withColumn("sin_numero", rest).withColumn("sufijo_numerico", number)
    core, form = T.split_legal_suffix(F.col("sin_numero"))
    text = text.withColumn("sufijo_societario", form).withColumn("nucleo", core).withColumn("tokens", T.tokens_of(F.col("nucleo"))).withColumn("tokens", T.expand_tokens(F.col("tokens")))
    return text.withColumn("nucleo", T.text_of(F.col("tokens"))).drop("palabras")


def document_frequency(records: DataFrame) -> DataFrame:
    """``(token, df)``: in how many records a token occurs."""
    return records.select(F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token").agg(F.count("*").alias("df"))


def generic_cut(n: int) -> int:
    return max(SETTINGS.generic_least, int(n * SETTINGS.generic_share))


def generic_tokens(frequency: DataFrame, n: int) -> list[str]:
    """Tokens of at least the cut-off: at most average tokens a record / share of them, whatever the input's size."""
    return sorted(r.token for r in frequency.where(F.col("df") >= generic_cut(n)).select("token").collect())


def neighbours(words: DataFrame) -> DataFrame:
    """``(idx, a, b)``: neighbouring words of ``(idx, palabras)`` that may be two parts of one; idx if there is one."""
    never = sorted({*rules.LEGAL_SUFFIXES, *rules.STOPWORDS, "CO", "CIA", "INC", "CORP", "LTD", "SA", "S"})
    able = lambda t: ~T.one_of(t, *never)
    pairs = F.transform(F.slice("palabras", F.lit(2), F.size("palabras")), lambda b, i: F.struct(F.element_at("palabras", i + 1).alias("a"), b.alias("b")))
    key = [c for c in words.columns if c == "idx"]
    rows = words.select(*key, F.explode(pairs).alias("p")).select(*key, "p.a", "p.b")
    return rows.where((F.length("a") >= 2) & F.length("b").between(1, SETTINGS.repair_tail) & able(F.col("a")) & able(F.col("b")))


def bigram_merges(words: DataFrame, frequency: DataFrame) -> DataFrame:
    """``(pair)``: neighbours 'a b' that are a word split where an enye was lost, as frequencies show."""
    whole = frequency.select(F.col("token").alias("whole"), F.col("df").alias("whole_df")).where(F.col("whole_df") >= SETTINGS.repair_df)
    first = frequency.select(F.col("token").alias("a"), F.col("df").alias("a_df"))
    found = neighbours(words).select("a", "b").distinct().withColumn("whole", F.concat("a", F.lit("N"), "b")).join(whole, "whole").join(first, "a", "left")
    return found.where(F.coalesce("a_df", F.lit(0)) <= F.col("whole_df")).select(F.concat_ws(" ", "a", "b").alias("pair"))


def joined_words(words: DataFrame, merges: DataFrame) -> DataFrame:
    """``words`` with the joins applied: each record meets the pairs that it holds, so no task needs all of them."""
    held = neighbours(words).select("idx", F.concat_ws(" ", "a", "b").alias("pair")).join(merges, "pair").groupBy("idx").agg(F.collect_set("pair").alias("_pairs"))
    rows = words.join(held, "idx", "left")
    return rows.withColumn("palabras", F.when(F.col("_pairs").isNull(), F.col("palabras")).otherwise(T.merge_bigrams(F.col("palabras"), F.col("_pairs")))).drop("_pairs")


def first_pass(names: DataFrame, knowledge: Knowledge | None = None) -> DataFrame:
    """Parts of all records by the rules alone."""
    return parts(cleaned(base_words(names), knowledge or default()))


def keyed(record_parts: DataFrame, generic: list[str], knowledge: Knowledge) -> DataFrame:
    """Adds comparison key and type."""
    is_generic = F.forall("tokens", lambda t: T.one_of(t, *generic)) if generic else F.size("tokens") == 0
    rows = record_parts.withColumn("clave_generica", is_generic)
    rows = rows.withColumn("clave", T.comparison_key(F.col("tokens"), F.col("sufijo_numerico"), F.col("clave_generica")))
    return rows.withColumn("tipo", record_type(F.col("sin_numero"), F.col("tokens"), F.col("sufijo_societario"), knowledge))


def records(names: DataFrame, knowledge: Knowledge | None = None, frequency: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(records after both passes, document frequencies of the first, which may be given)."""
    knowledge = knowledge or default()
    if frequency is None:
        frequency = durable(document_frequency(first_pass(names, knowledge)), "frequency")
    generic = generic_tokens(frequency, names.count())
    words = base_words(names)
    merges = durable(bigram_merges(words, frequency), "joins")
    second = parts(cleaned(joined_words(words, merges), knowledge))
    return keyed(second, generic, knowledge), frequency
