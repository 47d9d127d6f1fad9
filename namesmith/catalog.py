"""Registry of the engine's queries: name -> callable(spark, sf_dir), and DuckDB SQL for those that SQL can express.

Names come from keys of a driver table by one formula (``sources.names``), so every operator has an exact twin. The
queries run over all rows of that table.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles as O
from .functions import rules
from .functions import text as T
from .functions.similarity import indel_ratio, register, token_sort_ratio
from .operators import canonical, external, lexicon, records, reports, resolution, sectors, vocabulary
from .operators.knowledge import default, division_label, executive_view, macrosector
from .plans import pipeline
from .sources import files, sheets
from .sources.names import cut_names, cut_sql, drifting_names, drifting_sql, names, names_sql
from .storage import durable, shared_folder, ship
from .streaming import incremental

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
K = default()
C = O.Chain(K)
#: The names and chains of drifting ones, on which the guard of clustering has work to do.
D = O.Chain(K, f"{names_sql()} union all {drifting_sql()}")


def query(sql: str | None = None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(ship(spark), sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- stages that several queries share ---------------------------------------------------------------------------------


def first_pass(spark, sf_dir):
    return records.first_pass(names(spark, sf_dir), K)


def with_chains(spark, sf_dir) -> DataFrame:
    return names(spark, sf_dir).union(drifting_names(spark, sf_dir))


def keyed(spark, sf_dir, source=names) -> tuple[DataFrame, DataFrame]:
    parts = durable(records.first_pass(source(spark, sf_dir), K), "parts")
    frequency = durable(records.document_frequency(parts), "frequency")
    return records.keyed(parts, records.generic_tokens(frequency, parts.count()), K), frequency


def noded(spark, sf_dir, source=names) -> tuple[DataFrame, DataFrame, DataFrame]:
    rec, frequency = keyed(spark, sf_dir, source)
    node = durable(resolution.nodes(rec), "nodes")
    return node, durable(resolution.rare_tokens(node, frequency), "rare"), frequency


def decided(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    node, rare, _ = noded(spark, sf_dir)
    pairs = resolution.candidate_pairs(resolution.signals(rare))
    return durable(resolution.decide(pairs, node, rare, records.generic_cut(names(spark, sf_dir).count())), "decided"), node


def grouped(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Employer records with their exact key as cluster, the best of each, and frequencies."""
    rec, frequency = keyed(spark, sf_dir)
    own = durable(resolution.employers(rec).withColumn("cluster", F.col("clave")), "own")
    return own, canonical.best_variant(own, canonical.orthographic_quality(own, frequency)), frequency


# --- text ----------------------------------------------------------------------------------------------------------------


@query(C.sql(0, f"select idx, {O._strip('nombre_original')} as limpio from ({O.names_sql()})").replace("with recursive \n", ""))
def strip_export_prefix(spark, sf_dir):
    return names(spark, sf_dir).select("idx", T.strip_export_prefix(F.col("nombre_original")).alias("limpio"))


@query(f"select doc_id, {O._fold('text')} as plano from documents")
def fold_accents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", T.fold_accents(F.col("text")).alias("plano"))


@query(f"select doc_id, trim(regexp_replace(regexp_replace({O._fold('text')}, '[^A-Z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) as texto from documents")
def collapse_spaces(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", T.collapse_spaces(T.keep_charset(T.fold_accents(F.col("text")))).alias("texto"))


@query(C.sql(O.CLEAN, "select idx, b as limpio from based"))
def clean_text(spark, sf_dir):
    return names(spark, sf_dir).select("idx", T.clean_base(F.col("nombre_original")).alias("limpio"))


@query(C.sql(O.CLEAN, "select idx, j as limpio from joined"))
def repair_split_words(spark, sf_dir):
    return names(spark, sf_dir).select("idx", T.repair_split_words(T.clean_base(F.col("nombre_original"))).alias("limpio"))


@query(C.sql(O.CLEAN, "select idx, a as limpio from spelled"))
def join_spelled_acronyms(spark, sf_dir):
    return names(spark, sf_dir).select("idx", T.join_spelled_acronyms(T.repair_split_words(T.clean_base(F.col("nombre_original")))).alias("limpio"))


def _glued(spark, sf_dir):
    tokens = T.tokens_of(T.join_spelled_acronyms(T.repair_split_words(T.clean_base(F.col("nombre_original")))))
    return names(spark, sf_dir).select("idx", T.split_glued_suffix(tokens, list(K.words)).alias("t"))


@query(C.sql(O.CLEAN, f"select idx, {O._join('t8')} as limpio from glued"))
def split_glued_suffix(spark, sf_dir):
    return _glued(spark, sf_dir).select("idx", T.text_of(F.col("t")).alias("limpio"))


@query(C.sql(O.CLEAN, f"select idx, {O._join('t9')} as limpio from whole"))
def complete_truncated_stem(spark, sf_dir):
    return _glued(spark, sf_dir).select("idx", T.text_of(T.complete_truncated_stem(F.col("t"))).alias("limpio"))


@query(C.sql(O.TYPO, f"select idx, {O._join('palabras')} as limpio from tokened"))
def typo_correction(spark, sf_dir):
    return records.cleaned(records.base_words(names(spark, sf_dir)), K).select("idx", T.text_of(F.col("palabras")).alias("limpio"))


_NEVER = O.items(sorted({*rules.LEGAL_SUFFIXES, *rules.STOPWORDS, "CO", "CIA", "INC", "CORP", "LTD", "SA", "S"}))
_VALID = f"""bigrams as (select distinct t[i] as a, t[i + 1] as b from (select t, unnest(range(1, len(t))) as i from (select {O._split("j")} as t from joined))),
valid as (select p.a || ' ' || p.b as pair, w.df as whole_df from bigrams p join frequency w on w.token = p.a || 'N' || p.b left join frequency f on f.token = p.a
  where len(p.a) >= 2 and len(p.b) between 1 and 3 and p.a not in ({_NEVER}) and p.b not in ({_NEVER}) and w.df >= 3 and coalesce(f.df, 0) <= w.df)"""


@query(
    C.sql(
        O.PARTS,
        "select pair, whole_df from valid",
        _VALID,
    )
)
def corpus_bigram_repair(spark, sf_dir):
    """The joins that the corpus supports, with the frequency of the whole word."""
    frequency = durable(records.document_frequency(first_pass(spark, sf_dir)), "frequency")
    merges = records.bigram_merges(records.base_words(names(spark, sf_dir)), frequency)
    whole = F.concat(F.split_part("pair", F.lit(" "), F.lit(1)), F.lit("N"), F.split_part("pair", F.lit(" "), F.lit(2)))
    return merges.join(frequency, whole == F.col("token")).select("pair", F.col("df").alias("whole_df"))


#: The names, and some once more with words split where an N was lost.
_SPLIT = ("(LU|SIRE|MODER|LAGU|ORIE)N(A|O|TAL)", 100_000_000)
S = O.Chain(K, f"{names_sql()} union all select idx + {_SPLIT[1]} as idx, regexp_replace(nombre_original, '{_SPLIT[0]}', '\\1 \\2', 'g') as nombre_original from ({names_sql()}) where regexp_matches(nombre_original, '{_SPLIT[0]}') and idx % 3 = 0")


@query(
    S.sql(
        O.PARTS,
        "select idx, case when len(t) = 0 then '' else replace(list_reduce(t, lambda acc, x: case when list_contains(m, split_part(acc, ' ', -1) || ' ' || x) then acc || 'N' || x || '.' else acc || ' ' || x end), '.', '') end as limpio from (select idx, "
        + O._split("j")
        + " as t from joined), (select coalesce(list(distinct pair), []::varchar[]) as m from valid)",
        _VALID,
    )
)
def second_pass_words(spark, sf_dir):
    """The words of each name after the joins that the corpus supports, from left to right."""
    whole = names(spark, sf_dir)
    split = whole.where(F.col("nombre_original").rlike(_SPLIT[0]) & (F.col("idx") % 3 == 0))
    split = split.select((F.col("idx") + _SPLIT[1]).alias("idx"), F.regexp_replace("nombre_original", _SPLIT[0], "$1 $2").alias("nombre_original"))
    words = durable(records.base_words(whole.unionByName(split)), "words")
    frequency = durable(records.document_frequency(records.parts(records.cleaned(words, K))), "frequency")
    merges = durable(records.bigram_merges(words, frequency), "joins")
    return records.joined_words(words, merges).select("idx", T.text_of(F.col("palabras")).alias("limpio"))


@query(C.sql(O.CLEAN, "select idx, b as limpio from based"))
def fold_compatibility(spark, sf_dir):
    """The names written with full-width letters, ligatures, styled capitals and combining accents: cleaned, they are what they were."""
    c = F.translate(F.replace("nombre_original", F.lit("FI"), F.lit("ﬁ")), "ABGKOST", "Ａ𝐁ＧKŐŠŢ")
    for plain, odd in (("E", "E\u0301\u0323"), ("DZ", "ǅ"), ("IJ", "ĳ")):
        c = F.replace(c, F.lit(plain), F.lit(odd))
    return names(spark, sf_dir).select("idx", T.clean_base(c).alias("limpio"))


@query(C.sql(O.PARTS, "select idx, sin_numero, sufijo_numerico from parts"))
def split_numeric_suffix(spark, sf_dir):
    return first_pass(spark, sf_dir).select("idx", "sin_numero", "sufijo_numerico")


@query(C.sql(O.PARTS, "select idx, core, sufijo_societario from unsuffixed"))
def split_legal_suffix(spark, sf_dir):
    core, form = T.split_legal_suffix(F.col("sin_numero"))
    return first_pass(spark, sf_dir).select("idx", core.alias("core"), form.alias("sufijo_societario"))


@query(C.sql(O.PARTS, "select idx, nucleo from cored"))
def expand_tokens(spark, sf_dir):
    return first_pass(spark, sf_dir).select("idx", "nucleo")


@query(C.sql(O.PARTS, f"select idx, {O.reduced('tokens')} as reducido from parts"))
def remove_qualifiers(spark, sf_dir):
    return first_pass(spark, sf_dir).select("idx", T.text_of(T.remove_qualifiers(F.col("tokens"))).alias("reducido"))


@query(C.sql(O.PARTS, f"select idx, {O.title_case('nucleo')} as nombre from cored"))
def title_case_es(spark, sf_dir):
    return first_pass(spark, sf_dir).select("idx", T.title_case_es(F.col("nucleo")).alias("nombre"))


@query(C.sql(O.PARTS, "select idx, limpio, truncado from parts"))
def truncation_flag(spark, sf_dir):
    return first_pass(spark, sf_dir).select("idx", "limpio", "truncado")


# --- records ---------------------------------------------------------------------------------------------------------------


@query(C.sql(O.RECORDS, "select idx, clave from records"))
def comparison_key(spark, sf_dir):
    return keyed(spark, sf_dir)[0].select("idx", "clave")


@query(C.sql(O.RECORDS, "select idx, tipo from records"))
def record_type(spark, sf_dir):
    return keyed(spark, sf_dir)[0].select("idx", "tipo")


@query(C.sql(O.RECORDS, "select tipo, count(*) as n from records group by tipo"))
def type_counts(spark, sf_dir):
    return keyed(spark, sf_dir)[0].groupBy("tipo").agg(F.count("*").alias("n"))


@query(C.sql(O.RECORDS, f"select idx, {O.situation('limpio', 'tokens')} as situacion from records"))
def situation_category(spark, sf_dir):
    return keyed(spark, sf_dir)[0].select("idx", records.situation(F.col("limpio"), F.col("tokens")).alias("situacion"))


@query(C.sql(O.PARTS, "select idx, limpio from parts where regexp_matches(replace(limpio, ' ', ''), '^[0-9]+$') or len(replace(limpio, ' ', '')) >= 2 and replace(replace(limpio, ' ', ''), limpio[1], '') = ''"))
def unclassifiable(spark, sf_dir):
    return first_pass(spark, sf_dir).where(records.unclassifiable(F.col("limpio"))).select("idx", "limpio")


@query(C.sql(O.NODES, "select clave, count(*) as n from employers group by clave having count(*) > 1"))
def exact_groups(spark, sf_dir):
    return resolution.exact_groups(keyed(spark, sf_dir)[0])


@query(C.sql(O.NODES, "select clave, limpio, nucleo, reducido, truncado, n_registros from nodes"))
def key_representative(spark, sf_dir):
    return resolution.nodes(keyed(spark, sf_dir)[0]).select("clave", "limpio", "nucleo", "reducido", "truncado", "n_registros")


@query(C.sql(O.PARTS, "select token, df from frequency"))
def token_document_frequency(spark, sf_dir):
    return records.document_frequency(first_pass(spark, sf_dir))


@query(C.sql(O.PARTS, "select unnest(g) as token from generic"))
def generic_tokens(spark, sf_dir):
    parts = durable(first_pass(spark, sf_dir), "parts")
    n = parts.count()
    return records.document_frequency(parts).where(F.col("df") >= records.generic_cut(n)).select("token")


# --- profiling ---------------------------------------------------------------------------------------------------------------


@query(f"select len(t)::int as largo, count(*) as n from (select {O._strip('nombre_original')} as t from ({O.names_sql()})) where len(t) between 26 and 42 group by 1")
def length_histogram(spark, sf_dir):
    return reports.length_histogram(names(spark, sf_dir))


@query(f"select c as caracter, count(*) as n from (select unnest(string_split({O._strip('nombre_original')}, '')) as c from ({O.names_sql()})) where c <> '' group by 1")
def char_histogram(spark, sf_dir):
    return reports.char_histogram(names(spark, sf_dir))


_TESTS = [(n, f"regexp_matches(t, {O.q(p)})") for n, p in rules.PROFILE_PATTERNS] + [("LEN<=3", "len(t) <= 3"), ("APOSTROFO", "starts_with(trim(o), '''')"), ("TILDES", "regexp_matches(t, '[ÁÉÍÓÚÑÜáéíóúñü]')"), ("MINUSCULAS", "t <> upper(t)"), ("PANAMEA", "contains(t, 'PANAMEA')")]


@query(f"with b as (select nombre_original as o, {O._strip('nombre_original')} as t from ({O.names_sql()}) where nombre_original is not null) " + " union all ".join(f"select {O.q(n)} as patron, count(*) filter ({t}) as n from b" for n, t in _TESTS))
def pattern_profile(spark, sf_dir):
    return reports.profile(names(spark, sf_dir))


@query(
    f"""with b as (select {O._strip("nombre_original")} as b from ({O.names_sql()})), c as (select b, regexp_replace(b, '\\s+[0-9]+$', '') as c from b),
g as (select c, count(*) as n, count(*) filter (b <> c) as numbered from c group by c)
select sum(n)::bigint as nombres, sum(numbered)::bigint as con_numero, count(*) as distintos_sin_numero, count(*) filter (n > 1) as repetidos from g"""
)
def unicity_profile(spark, sf_dir):
    return reports.uniqueness(names(spark, sf_dir))


# --- blocking and matching ---------------------------------------------------------------------------------------------------


@query(C.sql(O.NODES, "select clave, token, df, rank from rare"))
def rare_tokens_top3(spark, sf_dir):
    return noded(spark, sf_dir)[1]


@query(C.sql(O.NODES, "select signal, clave from signals"))
def block_signals(spark, sf_dir):
    return resolution.signals(noded(spark, sf_dir)[1])


@query(C.sql(O.NODES, "select count(*) as n_signals, count(*) filter (size between 2 and 120) as n_useful, count(*) filter (size > 120) as n_oversized, coalesce(sum(size * (size - 1) / 2) filter (size between 2 and 120), 0)::bigint as n_pairs from blocks"))
def block_stats(spark, sf_dir):
    return resolution.block_stats(resolution.signals(noded(spark, sf_dir)[1]))


@query(C.sql(O.NODES, "select a, b from pairs"))
def candidate_pairs(spark, sf_dir):
    return resolution.candidate_pairs(resolution.signals(noded(spark, sf_dir)[1]))


_PARTS = "(select distinct p_name as x from part)"


@query("with recursive pairs as (select x.x, y.x as y from " + _PARTS + " x, " + _PARTS + " y where x.x < y.x and list_has_any(string_split(x.x, ' '), string_split(y.x, ' ')))," + O.ratio_ctes("pairs") + "\nselect x, y, r as ratio from ratios")
def indel_ratio_pairs(spark, sf_dir):
    """Pairs of distinct part names that share a word."""
    return _part_pairs(spark, sf_dir).select("x", "y", indel_ratio(F.col("x"), F.col("y")).alias("ratio"))


def _part_pairs(spark, sf_dir) -> DataFrame:
    words = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_name").alias("x")).distinct().select("x", F.explode(F.split("x", " ")).alias("word"))
    return words.join(words.withColumnRenamed("x", "y"), "word").where("x < y").select("x", "y").distinct()


@query(C.sql(O.NODES, "select p.a, p.b, r as ratio from sorted_pairs p join ratios using (x, y)", f"sorted_pairs as (select p.a, p.b, {O._SORTED.format('na.nucleo')} as x, {O._SORTED.format('nb.nucleo')} as y from pairs p join nodes na on na.clave = p.a join nodes nb on nb.clave = p.b)", O.ratio_ctes("sorted_pairs")))
def token_sort_ratio_pairs(spark, sf_dir):
    node, rare, _ = noded(spark, sf_dir)
    both = resolution.with_ends(resolution.candidate_pairs(resolution.signals(rare)), node)
    return both.select("a", "b", token_sort_ratio(F.col("a_nucleo"), F.col("b_nucleo")).alias("ratio"))


@query(C.sql(O.DECIDED, "select a, b, shared, score, accepted from accepted"))
def pair_decision(spark, sf_dir):
    return decided(spark, sf_dir)[0]


@query(C.sql(O.NODES, f"select p.a, p.b from pairs p join nodes na on na.clave = p.a join nodes nb on nb.clave = p.b where {O._CUT_OFF.format(s='na', l='nb')} or {O._CUT_OFF.format(s='nb', l='na')}"))
def truncation_pairs(spark, sf_dir):
    node, rare, _ = noded(spark, sf_dir)
    both = resolution.with_ends(resolution.candidate_pairs(resolution.signals(rare)), node)
    return both.where(resolution.truncation("a", "b") | resolution.truncation("b", "a")).select("a", "b")


@query(O.Chain(K, cut_sql()).sql(O.NODES, f"select s.clave as a, l.clave as b from nodes s, nodes l where s.clave <> l.clave and {O._CUT_OFF.format(s='s', l='l')}"))
def truncation_join(spark, sf_dir):
    """Cut-off names with all longer ones that they begin; the twin compares all pairs."""
    return resolution.truncation_join(durable(resolution.nodes(keyed(spark, sf_dir, cut_names)[0]), "nodes"))


_COHESION = f"""cohesion_sides as materialized (select p.a, p.b, {O._SORTED.format("na.nucleo")} as x, {O._SORTED.format("nb.nucleo")} as y, {O._SORTED.format("na.reducido")} as rx, {O._SORTED.format("nb.reducido")} as ry,
  len(na.limpio) >= 18 and starts_with(nb.limpio, na.limpio) or len(nb.limpio) >= 18 and starts_with(na.limpio, nb.limpio) as prefix
  from (select a, b from accepted where accepted) p join nodes na on na.clave = p.a join nodes nb on nb.clave = p.b),
cohesion_pairs as (select x, y from cohesion_sides union select rx, ry from cohesion_sides),
{O.ratio_ctes("cohesion_pairs").replace("lcs", "cohesion_lcs").replace("ratios", "cohesion_ratios")}"""


@query(C.sql(O.DECIDED, "select a, b, case when prefix then 100.0e0 else greatest(t.r, u.r) end as cohesion from cohesion_sides s join cohesion_ratios t on t.x = s.x and t.y = s.y join cohesion_ratios u on u.x = s.rx and u.y = s.ry", _COHESION))
def cohesion_pairs(spark, sf_dir):
    pairs, node = decided(spark, sf_dir)
    return resolution.cohesion(pairs.where("accepted").select("a", "b"), node)


@query(
    C.sql(
        O.DECIDED,
        "select node, min(reach) as component from reached group by node",
        """edges as (select a, b from accepted where accepted union select b, a from accepted where accepted),
reached(node, reach) as (select a, a from edges union select r.node, e.b from reached r join edges e on e.a = r.reach)""",
    )
)
def connected_components(spark, sf_dir):
    return resolution.components(decided(spark, sf_dir)[0].where("accepted"))


def guarded(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Members and disputed pairs of the names with the drifting ones, and their nodes."""
    node, rare, frequency = noded(spark, sf_dir, with_chains)
    n = with_chains(spark, sf_dir).count()
    pairs = resolution.decide(resolution.candidate_pairs(resolution.signals(rare)), node, rare, records.generic_cut(n))
    return durable(resolution.guarded_clusters(pairs, node, records.generic_tokens(frequency, n)), "merged"), node


_GUARDED = O.guarded_ctes()
_CLUSTERS = "clustered as (select n.clave, n.n_registros, coalesce(j.cluster, n.clave) as cluster from nodes n left join joined_ends j using (clave))"


@query(D.sql(O.DECIDED, "select clave, cluster, sha256(cluster) as stable_id from clustered", _GUARDED, _CLUSTERS))
def guarded_clusters(spark, sf_dir):
    return resolution.clusters(*guarded(spark, sf_dir))


@query(D.sql(O.DECIDED, "select a, b, cohesion, representante_a, representante_b, tokens_distintivos, row_number() over (order by tokens_distintivos desc, cohesion desc, a, b) as orden from disputed where kind = 'doubt'", _GUARDED))
def doubt_zone(spark, sf_dir):
    return resolution.doubt_list(guarded(spark, sf_dir)[0])


@query(D.sql(O.DECIDED, "select a, b, cohesion, representante_a, representante_b, tokens_distintivos, row_number() over (order by tokens_distintivos desc, cohesion desc, a, b) as orden from disputed where kind = 'discarded'", _GUARDED))
def discarded_merges(spark, sf_dir):
    return resolution.doubt_list(guarded(spark, sf_dir)[0], "discarded")


@query(D.sql(O.DECIDED, "select sum(k)::bigint as claves, count(*) as clusters, count(*) filter (k > 1) as clusters_multiples, coalesce(sum(n) filter (k > 1), 0)::bigint as registros_en_multiples from (select cluster, count(*) as k, sum(n_registros) as n from clustered group by cluster)", _GUARDED, _CLUSTERS))
def cluster_summary(spark, sf_dir):
    merged, node = guarded(spark, sf_dir)
    return resolution.cluster_summary(resolution.clusters(merged, node), node)


@query(
    C.sql(
        O.DECIDED,
        "select component, count(*) as n from (select node, min(reach) as component from reached group by node) group by component having count(*) > 1",
        """edges as (select a, b from accepted where accepted union select b, a from accepted where accepted),
reached(node, reach) as (select a, a from edges union select r.node, e.b from reached r join edges e on e.a = r.reach)""",
    )
)
def component_sizes(spark, sf_dir):
    return resolution.component_sizes(resolution.components(decided(spark, sf_dir)[0].where("accepted")))


@query(C.sql(O.NODES, "select clave, n, idx from employers join (select clave, count(*) as n from employers group by clave having count(*) > 1) using (clave)"))
def group_members(spark, sf_dir):
    return resolution.group_members(durable(keyed(spark, sf_dir)[0], "keyed"))


@query(C.sql(O.NODES, "select clave as cluster, count(*) as n, row_number() over (order by count(*) desc, clave) as rank from employers group by clave"))
def cluster_size_rank(spark, sf_dir):
    return resolution.size_rank(grouped(spark, sf_dir)[0])


# --- canonical names -----------------------------------------------------------------------------------------------------------

_QUALITY = """quality as materialized (select idx, coalesce(len(bin(min(coalesce(df, 1)) filter (token is not null))), 0)::int as calidad
  from (select idx, unnest(case when len(l) > 0 then l else [null] end) as token from (select idx, list_filter(list_distinct(tokens), lambda t: len(t) >= 4) as l from records)) left join frequency using (token) group by idx)"""
_BEST = (
    _QUALITY
    + """,
variants as (select e.clave as cluster, max(struct_pack(a := case when truncado then 0 else 1 end, b := calidad, c := len(tokens), d := case when sufijo_societario <> '' then 1 else 0 end, e := len(limpio), f := limpio, g := nucleo)) as m,
  count(*) as n_registros, count(distinct clave) as n_claves from employers e join quality using (idx) group by 1),
best as materialized (select v.cluster, m.f as limpio, m.g as nucleo, string_split(m.g, ' ') as tokens, n_registros, n_claves, m.a = 0 as truncado, m.d from variants v)"""
)
_SUFFIX = f"""forms as (select clave as cluster, sufijo_societario as s, count(*) as n, min(idx) as first from employers where sufijo_societario <> '' group by all),
top_forms as (select cluster, arg_max(s, struct_pack(n := n, f := -first)) as s, max(n) as n from forms group by cluster),
suffixes as (select b.cluster, case when nucleo is not null and string_split(nucleo, ' ')[1] not in ({O.items(rules.PUBLIC_HEADS)}) and 2 * t.n >= n_registros then t.s else '' end as sufijo from best b left join top_forms t using (cluster))"""


@query(C.sql(O.NODES, "select idx, calidad from quality", _QUALITY))
def orthographic_quality(spark, sf_dir):
    rec, frequency = keyed(spark, sf_dir)
    return canonical.orthographic_quality(rec, frequency)


@query(C.sql(O.NODES, "select cluster, limpio, nucleo, n_registros, n_claves from best", _BEST))
def best_variant(spark, sf_dir):
    return grouped(spark, sf_dir)[1].select("cluster", "limpio", "nucleo", "n_registros", "n_claves")


@query(C.sql(O.NODES, "select cluster, sufijo from suffixes", _BEST, _SUFFIX))
def majority_suffix(spark, sf_dir):
    own, best, _ = grouped(spark, sf_dir)
    return canonical.majority_suffix(own, best)


@query(
    C.sql(
        O.NODES,
        f"""select cluster, coalesce({O.employer(K, "g", "name")}, {O.title_case("nucleo")} || case when sufijo <> '' then ', ' || coalesce({O.mapped("sufijo", rules.LEGAL_FORM)}, sufijo) else '' end) as nombre_canonico,
case when g is null then 'reconstruccion' else 'gazetteer' end as origen_nombre from (select *, {O._gazetteer(K, "tokens")} as g from best join suffixes using (cluster))""",
        _BEST,
        _SUFFIX,
    )
)
def canonical_name(spark, sf_dir):
    own, best, _ = grouped(spark, sf_dir)
    best = durable(best, "best")
    return canonical.canonical_names(best, canonical.majority_suffix(own, best), K).select("cluster", "nombre_canonico", "origen_nombre")


# --- sectors -------------------------------------------------------------------------------------------------------------------


@query(C.sql(O.PARTS, f"select idx, {O._gazetteer(K, 'tokens')} as clave_maestro from cored"))
def gazetteer_lookup(spark, sf_dir):
    return first_pass(spark, sf_dir).select("idx", records.gazetteer_key(F.col("tokens"), K).alias("clave_maestro"))


@query(C.sql(O.PARTS, f"select idx, {O.phrase(K)} as frase from cored"))
def phrase_lookup(spark, sf_dir):
    return first_pass(spark, sf_dir).select("idx", sectors.phrase(F.col("nucleo"), K).alias("frase"))


@query(C.sql(O.PARTS, "select idx, t as palabra from cascade", O.cascade_ctes(K, "cored")))
def best_token(spark, sf_dir):
    return first_pass(spark, sf_dir).select("idx", sectors.best_token(F.col("tokens"), K).alias("palabra"))


@query(C.sql(O.PARTS, f"select token, {O.morphological(K, 'token')} as variante from frequency"))
def morphological_variant(spark, sf_dir):
    return records.document_frequency(first_pass(spark, sf_dir)).select("token", lexicon.morphological_variant(F.col("token"), K).alias("variante"))


@query(C.sql(O.PARTS, f"select token, {O.prefix(K, 'token')} as prefijo from frequency"))
def commercial_prefix(spark, sf_dir):
    return records.document_frequency(first_pass(spark, sf_dir)).select("token", lexicon.commercial_prefix(F.col("token"), K).alias("prefijo"))


@query(C.sql(O.PARTS, "select idx, ap as aprox from cascade", O.cascade_ctes(K, "cored")))
def approximate_token(spark, sf_dir):
    return sectors.approximate(first_pass(spark, sf_dir), K).select("idx", "aprox")


@query(C.sql(O.PARTS, "select idx, nivel, evidencia, seccion, division, peso from cascade", O.cascade_ctes(K, "cored")))
def sector_cascade(spark, sf_dir):
    return sectors.cascade(first_pass(spark, sf_dir), K).select("idx", "nivel", "evidencia", "seccion", "division", "peso")


@query(C.sql(O.PARTS, "select idx, nivel, evidencia, seccion, division, peso from cascade", O.cascade_ctes(K, "cored")))
def cascade_by_tables(spark, sf_dir):
    """The same evidence with catalogue and gazetteer as tables that joins meet."""
    rows = vocabulary.cascade(first_pass(spark, sf_dir), *vocabulary.tables(spark, K))
    return rows.select("idx", "nivel", "evidencia", "seccion", "division", "peso")


@query(
    C.sql(
        O.PARTS,
        "select c.idx, b.frase from cored c left join best b on b.nucleo = c.nucleo",
        """pairs as (select idx, t[i] || ' ' || t[i + 1] as p from (select idx, tokens as t, unnest(range(1, len(tokens))) as i from cored)),
phrases as (select p from pairs group by p having count(distinct idx) >= 2),
best as (select c.nucleo, arg_min(p.p, struct_pack(a := -len(p.p), b := instr(c.nucleo, p.p))) as frase from (select distinct nucleo from cored) c join phrases p on contains(c.nucleo, p.p) group by c.nucleo)""",
    )
)
def phrase_table_lookup(spark, sf_dir):
    """The longest of the word pairs that two records share, as a table of phrases, within each name."""
    rows = durable(first_pass(spark, sf_dir).select("idx", "nucleo", "tokens"), "cores")
    pairs = F.transform(F.slice("tokens", F.lit(2), F.size("tokens")), lambda b, i: F.concat(F.element_at("tokens", i + 1), F.lit(" "), b))
    phrases = rows.select("idx", F.explode(F.array_distinct(pairs)).alias("phrase")).groupBy("phrase").count().where("count >= 2").select("phrase")
    texts = durable(rows.select(F.col("nucleo").alias("text")).distinct(), "texts")
    found = vocabulary.longest_phrase(texts, durable(phrases, "phrases")).select(F.col("text").alias("nucleo"), F.col("phrase").alias("frase"))
    return vocabulary.met(rows, found, "nucleo", "idx", "left").select("idx", "frase")


_VOTE = f"""cores as (select clave as cluster, nucleo, min(tokens) as tokens, min(sufijo_societario) as sufijo_societario from employers group by clave, nucleo),
{O.cascade_ctes(K, "cores")},
ballots as (select cluster, seccion, division, nivel, {O.votes(K)} as v from cascade where seccion <> ''),
sums as (select cluster, seccion, division, sum(v)::bigint as v, arg_max(nivel, struct_pack(a := v, b := nivel)) as nivel from ballots group by cluster, seccion, division),
voted as materialized (select cluster, max(struct_pack(v := v, s := seccion, d := division, n := nivel)) as w from sums group by cluster)"""


@query(C.sql(O.NODES, "select cluster, w.s as seccion, w.d as division, w.v as votos, w.n as nivel from voted", _VOTE))
def sector_vote(spark, sf_dir):
    return sectors.vote(grouped(spark, sf_dir)[0], K)


def _resolved(spark, sf_dir) -> DataFrame:
    """(cluster, representante, seccion, division, nivel, peso) of key nodes, each by its own cascade."""
    node = noded(spark, sf_dir)[0].withColumn("sufijo_societario", F.lit(""))
    return durable(sectors.cascade(node.withColumn("tokens", T.tokens_of(F.col("nucleo"))), K).select(F.col("clave").alias("cluster"), F.col("nucleo").alias("representante"), "seccion", "division", "nivel", "peso", "n_registros"), "resolved")


_RESOLVED = "node_rows as (select clave as cluster, nucleo as representante, nucleo, string_split(nucleo, ' ') as tokens, '' as sufijo_societario, n_registros from nodes),\n" + O.cascade_ctes(K, "node_rows")


@query(
    C.sql(
        O.DECIDED,
        "select cluster, seccion, division, fuente, cohesion from heirs where k = 1",
        _RESOLVED,
        f"""doubts as (select a, b, score as cohesion from accepted where not accepted and score >= 60),
both_ways as (select a, b, cohesion from doubts union all select b, a, cohesion from doubts),
givers as (select * from cascade where seccion <> '' and (nivel in ('gazetteer', 'frase', 'propiedad_horizontal') or nivel = 'token' and peso between 7 and 9)),
linked as (select w.b, w.a, w.cohesion, s.seccion, s.division, list_filter(list_distinct(list_intersect(string_split(s.representante, ' '), string_split(t.representante, ' '))), lambda x: x not in ({O.items(rules.STOPWORDS)})) as comunes
  from both_ways w join givers s on s.cluster = w.a join cascade t on t.cluster = w.b and t.seccion = ''),
heirs as (select b as cluster, seccion, division, a as fuente, cohesion, row_number() over (partition by b order by len(comunes) desc, cohesion desc, a) as k from linked
  where len(comunes) = 0 or len(list_filter(comunes, lambda x: x not in ({O.items(K.proper_nouns)}))) > 0)""",
    )
)
def sector_propagation(spark, sf_dir):
    """Here the doubtful pairs are candidate pairs of 60 or more that weren't accepted, so that SQL has them too."""
    pairs, _ = decided(spark, sf_dir)
    doubts = pairs.where("not accepted and score >= 60").select("a", "b", F.col("score").alias("cohesion"))
    return sectors.propagate(_resolved(spark, sf_dir), doubts, K)


@query(C.sql(O.PARTS, "select c.idx, coalesce(m.marker, '') as marcador from cored c left join marked m on m.x = c.limpio", O.marker_ctes("cored", "limpio")))
def cluster_reclassification(spark, sf_dir):
    return first_pass(spark, sf_dir).select("idx", sectors.reclassified(F.col("limpio")).alias("marcador"))


_SECTIONS = "(select idx, seccion, division from cascade)"


@query(
    C.sql(
        O.PARTS,
        "select sector_ejecutivo, registros, round(100.0e0 * registros / sum(registros) over (), 4) as porcentaje from counted",
        O.cascade_ctes(K, "cored"),
        f"counted as (select {O.mapped('seccion', rules.EXECUTIVE)} as sector_ejecutivo, count(*) as registros from cascade where seccion <> '' group by 1)",
    )
)
def sector_concentration(spark, sf_dir):
    return reports.concentration(sectors.cascade(first_pass(spark, sf_dir), K))


@query(C.sql(O.PARTS, f"select idx, {O.mapped('seccion', rules.EXECUTIVE, O.q('Sin clasificar'))} as vista, coalesce({O.mapped('seccion || division', rules.DIVISIONS)}, {O.mapped('seccion', rules.SECTIONS)}) as etiqueta from cascade", O.cascade_ctes(K, "cored")))
def executive_view_labels(spark, sf_dir):
    rows = sectors.cascade(first_pass(spark, sf_dir), K)
    return rows.select("idx", executive_view(F.col("seccion")).alias("vista"), division_label(F.col("seccion"), F.col("division")).alias("etiqueta"))


@query(
    C.sql(
        O.RECORDS,
        f"select idx, case when seccion <> '' then {O.mapped('seccion', rules.SECTIONS)} when tipo in ({O.items(rules.EMPLOYER_TYPES)}) then {O.q(rules.PENDING_LABEL)} when starts_with(nombre_original, 'No identificable') then 'No identificable' else {O.q(rules.NO_CORPORATE_LINK)} end as macrosector from cascade",
        O.cascade_ctes(K, "records"),
    )
)
def macrosector_labels(spark, sf_dir):
    rows = sectors.cascade(keyed(spark, sf_dir)[0], K)
    return rows.select("idx", macrosector(F.col("seccion"), F.col("tipo"), F.col("nombre_original")).alias("macrosector"))


# --- confidence ------------------------------------------------------------------------------------------------------------------

_ID = O.mapped("origen_nombre", rules.IDENTITY_FACTOR, "0.7").replace(" then ", " then 1e0 * ")
_SEC = "case when nivel = 'token' then 0.55e0 + 0.05e0 * least(peso, 9) else " + O.mapped("nivel", rules.SECTOR_FACTOR, "0.5").replace(" then ", " then 1e0 * ") + " end"
_SCORED = f"""score_rows as (select r.*, case when gk is null then 'reconstruccion' else 'gazetteer' end as origen_nombre, (idx % 14)::int as n_claves from cascade r),
points as (select *, 100.0e0 * ({_ID}) * ({_SEC}) + (case when truncado and n_claves = 1 then -12 else 0 end)::double + (case when len(tokens) = 1 then -6 else 0 end)::double
  + (case when len(tokens) > 0 and len(list_filter(tokens, lambda t: len(t) > 2)) = 0 then -10 else 0 end)::double + (case when clave_generica and sufijo_numerico <> '' then -8 else 0 end)::double
  + (case when n_claves >= 12 and origen_nombre not in ('gazetteer', 'reclasificacion_cluster') then -10 else 0 end)::double + (case when n_claves between 2 and 11 then least(6, n_claves) else 0 end)::double as pts from score_rows),
scores as materialized (select *, round_even(greatest(0.0e0, least(100.0e0, pts)), 0)::int as confianza from points)"""
_BAND = "case when confianza >= 85 then 'automatico' when confianza >= 70 then 'muestreo' when confianza >= 50 then 'revision' else 'verificacion_individual' end"


def _scored(spark, sf_dir) -> DataFrame:
    """Every record as a cluster of ``idx mod 14`` keys, named by the gazetteer if it is there."""
    rows = sectors.cascade(keyed(spark, sf_dir)[0], K)
    known = records.gazetteer_key(F.col("tokens"), K).isNotNull()
    return canonical.confidence(rows.withColumn("origen_nombre", F.when(known, "gazetteer").otherwise("reconstruccion")).withColumn("n_claves", (F.col("idx") % 14).cast("int")))


@query(C.sql(O.RECORDS, "select idx, confianza from scores", O.cascade_ctes(K, "records"), _SCORED))
def confidence_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("idx", "confianza")


@query(C.sql(O.RECORDS, f"select {_BAND} as banda, count(*) as n from scores group by 1", O.cascade_ctes(K, "records"), _SCORED))
def confidence_band(spark, sf_dir):
    return _scored(spark, sf_dir).groupBy("banda").agg(F.count("*").alias("n"))


@query(C.sql(O.RECORDS, "select list_sort(list(confianza))[count(*) // 2 + 1] as mediana from scores", O.cascade_ctes(K, "records"), _SCORED))
def upper_median(spark, sf_dir):
    return reports.upper_median(_scored(spark, sf_dir), "confianza")


@query("select list_sort(list(l_extendedprice))[count(*) // 2 + 1] as mediana from lineitem where l_extendedprice is not null")
def median_price(spark, sf_dir):
    """The upper median of a column of many distinct doubles."""
    return reports.upper_median(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_extendedprice")


_DIMENSIONS = ("tipo", "seccion", "vista", "banda", "origen_nombre", "origen_sector")


@query(
    C.sql(
        O.RECORDS,
        "select case " + " ".join(f"when grouping({d}) = 0 then '{d}'" for d in _DIMENSIONS) + " else 'total' end as dimension, coalesce(" + ", ".join(_DIMENSIONS) + ") as valor, count(*) as n, round(100.0e0 * count(*) / (select count(*) from counted), 4) as porcentaje from counted group by grouping sets (" + ", ".join(f"({d})" for d in _DIMENSIONS) + ", ())",
        O.cascade_ctes(K, "records"),
        _SCORED,
        f"counted as (select tipo, seccion, coalesce({O.mapped('seccion', rules.EXECUTIVE)}, 'Sin clasificar') as vista, {_BAND} as banda, origen_nombre, nivel as origen_sector from scores)",
    )
)
def counters(spark, sf_dir):
    """All counters of a load in one pass."""
    return reports.counters(_scored(spark, sf_dir), {"tipo": F.col("tipo"), "seccion": F.col("seccion"), "vista": executive_view(F.col("seccion")), "banda": F.col("banda"), "origen_nombre": F.col("origen_nombre"), "origen_sector": F.col("nivel")})


@query(
    C.sql(
        O.RECORDS,
        "select idx, concat_ws(' | ', 'tipo ' || tipo, 'sector ' || nivel, case when evidencia <> '' then 'evidencia ' || evidencia end, confianza || ' ' || " + _BAND + ") as traza from scores",
        O.cascade_ctes(K, "records"),
        _SCORED,
    )
)
def explain_trace(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    return rows.select("idx", F.concat_ws(" | ", F.concat(F.lit("tipo "), "tipo"), F.concat(F.lit("sector "), "nivel"), F.when(F.col("evidencia") != "", F.concat(F.lit("evidencia "), "evidencia")), F.concat(F.col("confianza").cast("string"), F.lit(" "), "banda")).alias("traza"))


# --- reports ---------------------------------------------------------------------------------------------------------------------

_EMP = f"tipo in ({O.items(rules.EMPLOYER_TYPES)})"


@query(
    C.sql(
        O.RECORDS,
        """select registros, empleadores, empleadores_unicos, con_sector, round_even(100.0e0 * empleadores / registros, 2) as pct_empleadores, round_even(100.0e0 * (empleadores - empleadores_unicos) / empleadores, 2) as pct_consolidacion,
round_even(100.0e0 * con_sector / empleadores, 2) as cobertura_publicada, round_even(100.0e0 * con_sector_empleador / empleadores, 2) as cobertura_empleadores, round_even(media, 1) as confianza_media,
banda_automatico, banda_muestreo, banda_revision, banda_verificacion_individual from kpi""",
        O.cascade_ctes(K, "records"),
        _SCORED,
        f"""banded as (select *, {_BAND} as banda from scores),
kpi as (select count(*) as registros, count(*) filter ({_EMP}) as empleadores, count(distinct case when {_EMP} then clave end) as empleadores_unicos, count(*) filter (seccion <> '') as con_sector,
  count(*) filter (seccion <> '' and {_EMP}) as con_sector_empleador, avg(confianza) as media, count(*) filter (banda = 'automatico') as banda_automatico, count(*) filter (banda = 'muestreo') as banda_muestreo,
  count(*) filter (banda = 'revision') as banda_revision, count(*) filter (banda = 'verificacion_individual') as banda_verificacion_individual from banded)""",
    )
)
def kpi_summary(spark, sf_dir):
    return reports.kpis(_scored(spark, sf_dir).withColumn("cluster", F.col("clave")))


_BLOCK = f"case when {_EMP} then 'empleador sin sector' when starts_with(nombre, 'No identificable') then 'no identificable' else 'situacion laboral' end"
_NAMED = f"labelled as (select *, case when {_EMP} then nucleo else {O.mapped('tipo', {t: v[0] for t, v in rules.TYPE_LABELS.items()})} end as nombre from cascade)"
_OPEN = f"(seccion = '' or not {_EMP})"


def _backlog(spark, sf_dir) -> DataFrame:
    rows = sectors.cascade(keyed(spark, sf_dir)[0], K)
    label = F.element_at(F.create_map(*[x for t, v in rules.TYPE_LABELS.items() for x in (F.lit(t), F.lit(v[0]))]), F.col("tipo"))
    return rows.withColumn("nombre_propuesto", F.when(F.col("tipo").isin(*rules.EMPLOYER_TYPES), F.col("nucleo")).otherwise(label))


@query(C.sql(O.RECORDS, f"select {_BLOCK} as bloque, idx, nombre_original, nombre as nombre_propuesto, tipo from labelled where {_OPEN}", O.cascade_ctes(K, "records"), _NAMED))
def review_backlog(spark, sf_dir):
    return reports.review_backlog(_backlog(spark, sf_dir))


@query(C.sql(O.RECORDS, f"select bloque, idx, nombre, nombre_original, nombre_propuesto, tipo, row_number() over (order by bloque, nombre, idx) as orden from (select {_BLOCK} as bloque, idx, {O._strip('nombre_original')} as nombre, nombre_original, nombre as nombre_propuesto, tipo from labelled where {_OPEN})", O.cascade_ctes(K, "records"), _NAMED))
def review_list(spark, sf_dir):
    return reports.review_list(reports.review_backlog(_backlog(spark, sf_dir)))


@query(
    C.sql(
        O.RECORDS,
        """select palabra, count(*) filter (bloque = 'no identificable') as no_identificable, count(*) filter (bloque = 'situacion laboral') as situacion_laboral,
count(*) filter (bloque = 'empleador sin sector') as empleador_sin_sector, count(*) as total from (select bloque, unnest(list_distinct(tokens)) as palabra from open) group by palabra""",
        O.cascade_ctes(K, "records"),
        _NAMED,
        f"open as (select {_BLOCK} as bloque, tokens from labelled where {_OPEN})",
    )
)
def vocabulary_pivot(spark, sf_dir):
    rows = _backlog(spark, sf_dir)
    return reports.vocabulary_pivot(reports.review_backlog(rows).select("bloque", "idx").join(rows.select("idx", "tokens"), "idx"))


@query(C.sql(O.NODES, "select clave as cluster, count(*) as registros, min_by(limpio, idx) as limpio, min_by(sufijo_societario, idx) as sufijo_societario from employers group by clave"))
def master_first_record(spark, sf_dir):
    own = grouped(spark, sf_dir)[0].select("cluster", "idx", "clave", "limpio", "sufijo_societario")
    return reports.master(own).select("cluster", "registros", "limpio", "sufijo_societario")


@query(C.sql(O.PARTS, "select token, df from frequency order by df desc, token limit 15"))
def top_tokens(spark, sf_dir):
    return reports.top_n(records.document_frequency(first_pass(spark, sf_dir)), "df", 15, "token")


# --- external validation, offline ------------------------------------------------------------------------------------------------

_QUEUE = "queue as (select cluster, representante, n_registros, (row_number() over (order by n_registros desc, cluster) - 1)::bigint as n from cascade where seccion = ''),\ncache as (select representante as nombre from cascade where cluster >= 'M')"


def _queue(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    resolved = _resolved(spark, sf_dir)
    return external.pending(resolved), resolved.where("cluster >= 'M'").select(F.col("representante").alias("nombre"))


@query(C.sql(O.NODES, "select cluster, representante, n_registros, n from queue", _RESOLVED, _QUEUE))
def pending_by_priority(spark, sf_dir):
    return _queue(spark, sf_dir)[0].withColumn("n", F.col("n").cast("long"))


@query(C.sql(O.NODES, "select cluster, representante from queue where representante not in (select nombre from cache)", _RESOLVED, _QUEUE))
def cache_antijoin(spark, sf_dir):
    return external.not_cached(*_queue(spark, sf_dir)).select("cluster", "representante")


@query(C.sql(O.NODES, "select distinct nombre from cache where nombre in (select representante from queue)", _RESOLVED, _QUEUE))
def cache_semijoin(spark, sf_dir):
    queue, cache = _queue(spark, sf_dir)
    return external.cached(cache, queue).distinct()


@query(C.sql(O.NODES, "select cluster, n // 40 as lote from queue", _RESOLVED, _QUEUE))
def batch_assignment(spark, sf_dir):
    return external.batches(_queue(spark, sf_dir)[0]).select("cluster", "lote")


@query(C.sql(O.NODES, "select cluster, n // 40 as lote from queue where n // 40 < 2", _RESOLVED, _QUEUE))
def budget_limit(spark, sf_dir):
    return external.within_budget(_queue(spark, sf_dir)[0], 2).select("cluster", "lote")


@query(
    """with n as (select count(*) as nombres from customer), c as (select nombres, floor((nombres + 39) / 40.0e0) as calls from n)
select nombres, calls::bigint as llamadas, floor(calls * 480 + 857 * 1.25e0)::bigint as tokens_entrada, floor((calls - 1) * 857)::bigint as tokens_cache, (calls * 2200)::bigint as tokens_salida,
round((calls * 480 + 857 * 1.25e0) / 1e6 * 5.0e0 + (calls - 1) * 857 / 1e6 * 0.5e0 + calls * 2200 / 1e6 * 25.0e0, 2) as costo_usd from c"""
)
def cost_estimate(spark, sf_dir):
    return external.cost(names(spark, sf_dir).agg(F.count("*").alias("nombres")), 3000)


def _answers(spark, sf_dir) -> DataFrame:
    """Invented answers, some with a pair that no catalogue has."""
    queue = _queue(spark, sf_dir)[0]
    return queue.select(F.col("representante").alias("nombre"), F.initcap("representante").alias("nombre_canonico"), F.when(F.col("n") % 3 == 0, "Z").otherwise("G").alias("seccion"), F.lit("47").alias("division"), F.when(F.col("n") % 2 == 0, "alta").otherwise("baja").alias("confianza"), F.lit("x").alias("motivo"))


@query(C.sql(O.NODES, "select representante as nombre, case when n % 3 = 0 then '' else 'G' end as seccion, case when n % 3 = 0 then '' else '47' end as division, case when n % 3 = 0 then 'ninguna' when n % 2 = 0 then 'alta' else 'baja' end as confianza from queue", _RESOLVED, _QUEUE))
def answer_validation(spark, sf_dir):
    return external.validated(_answers(spark, sf_dir)).select("nombre", "seccion", "division", "confianza")


def _client(names: list[str]) -> str:
    """A stand-in for a model: answers by the lengths of names; some calls fail, some answers are malformed, short or repeat a number."""
    kind = len(names[0]) % 5
    if kind == 0:
        return '{"resultados": [{"n": 1,'
    if kind == 1:
        raise TimeoutError("no answer")
    found = [{"n": k, "nombre_canonico": x, "seccion": "G" if len(x) % 2 else "Z", "division": "47", "confianza": "alta" if len(x) % 3 else "baja", "motivo": "x"} for k, x in enumerate(names, 1)]
    if kind == 2:
        found = found[:-1]
    if kind == 3:
        found += [found[0] | {"seccion": "C"}, found[0] | {"n": 99}, {"n": "first"}, "x"]
    return json.dumps({"resultados": found})


def _asked(spark, sf_dir) -> DataFrame:
    return durable(external.asked(external.batches(_queue(spark, sf_dir)[0], 3), _client, wait=0), "answers")


_ASKED = "asked as (select n // 3 as lote, len(arg_min(representante, n)) % 5 as kind, max(n) as last, count(*)::int as pedidos from queue group by 1)"


@query(
    C.sql(
        O.NODES,
        "select distinct representante as nombre, case when len(representante) % 2 = 1 then 'G' else '' end as seccion, case when len(representante) % 2 = 1 then '47' else '' end as division, case when len(representante) % 2 = 0 then 'ninguna' when len(representante) % 3 = 0 then 'baja' else 'alta' end as confianza from queue join asked on lote = n // 3 where kind > 1 and not (kind = 2 and n = last)",
        _RESOLVED,
        _QUEUE,
        _ASKED,
    )
)
def external_answers(spark, sf_dir):
    """The queue asked batch by batch on the executors, read as JSON, put into a cache (twice, as one load) and validated from there."""
    answers, cache = external.parsed(_asked(spark, sf_dir)), _own_file(spark, "cache")
    for _ in range(2):
        external.remember(answers, cache, "1")
    return external.validated(external.remembered(spark, cache)).select("nombre", "seccion", "division", "confianza")


@query(
    C.sql(
        O.NODES,
        "select lote, pedidos, (case kind when 0 then 0 when 1 then 0 when 2 then pedidos - 1 else pedidos end)::int as respondidos, case kind when 1 then 3 else 1 end as intentos, case kind when 0 then 'malformada' when 1 then 'fallida' when 2 then 'parcial' else 'completa' end as estado from asked",
        _RESOLVED,
        _QUEUE,
        _ASKED,
    )
)
def answer_log(spark, sf_dir):
    return external.answer_log(_asked(spark, sf_dir))


@query(
    C.sql(
        O.NODES,
        "select c.cluster, case when a.nombre is not null then 'G' else c.seccion end as seccion, case when a.nombre is not null then 'llm_' || a.c else c.nivel end as nivel from cascade c left join answered a on a.nombre = c.representante and c.nivel = 'sin_evidencia'",
        _RESOLVED,
        _QUEUE,
        "answered as (select representante as nombre, min(case when n % 2 = 0 then 'alta' else 'baja' end) as c from queue where n % 3 <> 0 group by 1)",
    )
)
def external_merge(spark, sf_dir):
    return external.merge(_resolved(spark, sf_dir), external.validated(_answers(spark, sf_dir))).select("cluster", "seccion", "nivel")


# --- whole flow --------------------------------------------------------------------------------------------------------------------


@query()
def pipeline_end_to_end(spark, sf_dir):
    return pipeline.run(names(spark, sf_dir)).audit.drop("tokens")


@query(C.sql(0, f"select idx, coalesce(nombre_original, '') as nombre_original from ({O.names_sql()})").replace("with recursive \n", ""))
def csv_gzip_round_trip(spark, sf_dir):
    """Written as gzip CSV into the shared folder and read back with a fixed schema."""
    return files.csv_round_trip(names(spark, sf_dir))


# --- sources, sinks, splits and lists of the whole flow ------------------------------------------------------------------------


def _own_file(spark, kind: str) -> str:
    return f"{shared_folder(spark)}/namesmith/{kind}-{uuid.uuid4().hex}"


@query(f"select coalesce(nombre_original, '') as texto from ({O.names_sql()})")
def xlsx_round_trip(spark, sf_dir):
    """Written as a workbook into the shared folder and read back; the header is checked."""
    path = _own_file(spark, "names") + ".xlsx"
    sheets.write_xlsx(names(spark, sf_dir).select("nombre_original", "idx"), path, "ORIGINAL")
    return sheets.read_xlsx(spark, path, "nombre_original", "ORIGINAL").select("texto")


@query(ORACLES["kpi_summary"])
def json_round_trip(spark, sf_dir):
    """The indicators written as JSON into the shared folder and read back."""
    path, kpis = _own_file(spark, "kpis"), kpi_summary(spark, sf_dir)
    files.write_json(kpis, path)
    return files.read_json_rows(spark, path, kpis.schema)


@query(f"select idx, nombre_original from ({O.names_sql()})")
def optional_input(spark, sf_dir):
    """The names and an optional table that isn't there."""
    return names(spark, sf_dir).union(files.read_optional(spark, _own_file(spark, "absent"), files.NAMES))


@query(C.sql(O.RECORDS, f"select distinct seccion, division, coalesce({O.mapped('seccion || division', rules.DIVISIONS)}, {O.mapped('seccion', rules.SECTIONS)}) as etiqueta from cascade where seccion <> ''", O.cascade_ctes(K, "records")))
def prompt_catalogue(spark, sf_dir):
    """The listing for the prompt: sections and divisions that the evidence in the names speaks of, with their labels."""
    return external.listing(sectors.cascade(keyed(spark, sf_dir)[0], K))


_SAMPLE = f"based_names as (select idx, {O._strip('nombre_original')} as nombre, md5('2026:' || idx) as h from ({O.names_sql()}))"


@query(
    f"with {_SAMPLE} "
    + " union all ".join(
        f"select {O.q(label)} as muestra, p::int as puesto, idx, nombre from (select *, row_number() over (order by h, idx) as p from based_names where {holds}) where p <= {k}"
        for label, holds, k in (("general", "true", 30), ("truncados", "len(nombre) = 30", 15), ("cortos", "len(nombre) <= 6", 20))
    )
)
def seeded_samples(spark, sf_dir):
    return reports.samples(names(spark, sf_dir))


_LABELS = {t: v[0] for t, v in rules.TYPE_LABELS.items()}


@query(
    C.sql(
        O.RECORDS,
        f"""select idx, case when tipo in ('INACTIVO', 'ANOTACION') and s <> '' then s else {O.mapped('tipo', _LABELS)} end as nombre_propuesto,
case when kept then coalesce({O.mapped('seccion || division', rules.DIVISIONS)}, {O.mapped('seccion', rules.SECTIONS)}) else {O.mapped('tipo', {t: v[1] for t, v in rules.TYPE_LABELS.items()})} end as sector_propuesto,
case when kept then seccion else '' end as seccion, {O.mapped('tipo', {t: v[2] for t, v in rules.TYPE_LABELS.items()})}::int as confianza
from (select *, {O.situation('limpio', 'tokens')} as s, tipo in ({O.items(rules.SECTOR_KEEPERS)}) and seccion <> '' as kept from cascade) where not ({_EMP})""",
        O.cascade_ctes(K, "records"),
    )
)
def non_employer_labels(spark, sf_dir):
    return pipeline.non_employers(keyed(spark, sf_dir)[0], K).select("idx", "nombre_propuesto", "sector_propuesto", "seccion", "confianza")


@query(C.sql(O.RECORDS, f"select tipo, {_EMP} as empleador, count(*) as n from records group by all"))
def employer_split(spark, sf_dir):
    """Employers and the others, as the flow parts them."""
    rec = durable(keyed(spark, sf_dir)[0], "keyed")
    own, others = resolution.employers(rec), resolution.others(rec)
    return own.withColumn("empleador", F.lit(True)).union(others.withColumn("empleador", F.lit(False))).groupBy("tipo", "empleador").agg(F.count("*").alias("n"))


@query(
    C.sql(
        O.RECORDS,
        f"""select nombre_original, upper(nombre) as nombre_propuesto, coalesce({O.mapped('seccion || division', rules.DIVISIONS)}, {O.mapped('seccion', rules.SECTIONS)}, {O.q(rules.PENDING_LABEL)}) as sector_propuesto,
case when seccion <> '' then {O.mapped('seccion', rules.SECTIONS)} when {_EMP} then {O.q(rules.PENDING_LABEL)} when starts_with(nombre, 'No identificable') then 'No identificable' else {O.q(rules.NO_CORPORATE_LINK)} end as macrosector from labelled""",
        O.cascade_ctes(K, "records"),
        _NAMED,
    )
)
def deliverable_columns(spark, sf_dir):
    """The four delivered columns of every record, named by its own core."""
    rows = _backlog(spark, sf_dir).withColumn("sector_propuesto", F.coalesce(division_label(F.col("seccion"), F.col("division")), F.lit(rules.PENDING_LABEL)))
    return pipeline.deliverable(rows.withColumn("macrosector", macrosector(F.col("seccion"), F.col("tipo"), F.col("nombre_propuesto"))))


@query(ORACLES["indel_ratio_pairs"])
def sql_similarity(spark, sf_dir):
    """The kernel called from SQL."""
    register(spark)
    _part_pairs(spark, sf_dir).createOrReplaceTempView("namesmith_pairs")
    return spark.sql("select x, y, indel_ratio(x, y) as ratio from namesmith_pairs")


@query(C.sql(O.RECORDS, "select idx, nombre_original, r.clave, tipo, m.clave as cluster from records r left join (select distinct clave from records where tipo = 'EMPRESA' and clave < 'M') m using (clave)"))
def streaming_resolution(spark, sf_dir):
    """The names as a stream, resolved against a master: half of the alphabet of company keys."""
    rec, frequency = keyed(spark, sf_dir)
    master = durable(rec.where("tipo = 'EMPRESA' and clave < 'M'").select("clave", F.col("clave").alias("cluster")).distinct(), "master")
    folder = _own_file(spark, "stream")
    names(spark, sf_dir).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(files.NAMES).parquet(f"{folder}/in")
    incremental.start(stream, master, records.generic_tokens(frequency, rec.count()), f"{folder}/out", f"{folder}/checkpoint", K).awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("lote")


@query(D.sql(O.DECIDED, "select clave, cluster from clustered", _GUARDED, _CLUSTERS))
def incremental_clusters(spark, sf_dir):
    """Clusters that a stream keeps up to date over three loads: those of one run over all names."""
    return incremental_master(spark, sf_dir).read("members", 2).select("clave", "cluster")


def incremental_master(spark, sf_dir) -> incremental.Master:
    source = with_chains(spark, sf_dir)
    frequency = keyed(spark, sf_dir, with_chains)[1]
    n = source.count()
    folder = _own_file(spark, "loads")
    statistics = incremental.Statistics(frequency, records.generic_tokens(frequency, n), records.generic_cut(n))
    master = incremental.Master(spark, f"{folder}/master", statistics, K)
    for load in range(3):
        source.where(F.pmod(F.xxhash64("idx"), F.lit(3)) == load).write.parquet(f"{folder}/in/{load}")
        stream = spark.readStream.schema(files.NAMES).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
        incremental.maintain(stream, master, f"{folder}/checkpoint").awaitTermination()
    return master
