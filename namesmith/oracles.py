"""DuckDB twins of the queries, written independently of the Spark expressions over the same rule tables."""

from __future__ import annotations

from .functions import rules
from .functions.text import ACCENTED, PLAIN
from .operators.knowledge import Knowledge, default
from .operators.sectors import MARKERS, VOTES
from .sources.names import names_sql

S = rules.SETTINGS


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def items(values) -> str:
    return ", ".join(q(v) for v in values)


def table_of(name: str, columns: str, rows) -> str:
    cell = lambda v: q(v) if isinstance(v, str) else repr(v)
    return f"{name}({columns}) as (values " + ", ".join("(" + ", ".join(cell(v) for v in r) + ")" for r in rows) + ")"


def _fold(x: str) -> str:
    return f"upper(translate(replace({x}, 'ß', 'ss'), {q(ACCENTED)}, {q(PLAIN)}))"


def _strip(x: str) -> str:
    return f"trim(regexp_replace(trim(coalesce({x}, '')), '^''', ''))"


def _base(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace({_fold(_strip(x))}, '[^A-Z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"


def _chain(x: str, pairs) -> str:
    for pattern, word in pairs:
        x = f"regexp_replace({x}, {q(pattern)}, {q(word)}, 'g')"
    return x


def _split(x: str) -> str:
    return f"case when {x} = '' then []::varchar[] else string_split({x}, ' ') end"


def _join(x: str) -> str:
    return f"coalesce(array_to_string({x}, ' '), '')"


def _any(tokens: str, words) -> str:
    return f"list_has_any({tokens}, [{items(words)}])"


def _phrase(text: str, markers) -> str:
    return f"({text} in ({items(markers)})" + "".join(f" or contains({text}, {q(m)})" for m in markers if " " in m) + ")"


def _loose(tokens: str, markers) -> str:
    return _any(tokens, [m for m in markers if " " not in m])


def _drop(tokens: str, words) -> str:
    return f"list_filter({tokens}, lambda t: t not in ({items(words)}))"


def _kept(candidate: str, fallback: str) -> str:
    return f"case when len({candidate}) > 0 then {candidate} else {fallback} end"


def _case(pairs, other: str) -> str:
    return "case " + " ".join(f"when {c} then {v}" for c, v in pairs) + f" else {other} end"


def ratio_ctes(pairs: str) -> str:
    """CTEs lcs and ratios(x, y, r) over ``pairs(x, y)``: the table of the longest common subsequence, row by row."""
    return f"""
lcs(x, y, i, r) as (
  select x, y, 0, list_transform(range(0, len(y) + 1), lambda j: 0::bigint) from (select distinct x, y from {pairs})
  union all
  select x, y, i + 1, list_reduce(list_transform(range(1, len(y) + 1), lambda j: [case when substr(x, i + 1, 1) = substr(y, j, 1) then r[j] + 1 else r[j + 1] end]),
                                  lambda acc, v: list_append(acc, greatest(acc[len(acc)], v[1])), [0::bigint])
  from lcs where i < len(x)),
ratios as (select x, y, 200.0e0 * r[len(y) + 1] / (len(x) + len(y)) as r from lcs where i = len(x))"""


def clean_ctes(k: Knowledge, source: str) -> str:
    bases = items(k.words)
    glued = _case([(f"ends_with(t, {q(s)}) and len(t) >= {len(s) + S.glued_base} and t[:len(t) - {len(s)}] in ({bases})", f"[t[:len(t) - {len(s)}], {q(s)}]") for s in rules.GLUED_SUFFIXES], "[t]")
    stems = _case([(f"starts_with(t, {q(a)}) and t <> {q(b)}", q(b)) for a, b in rules.TRUNCATED_STEMS], "t")
    words = _chain("b", [(f"\\b{a} +{b}\\b", w) for a, b, w in rules.SPLIT_WORDS])
    return f"""names as ({source}),
based as (select idx, nombre_original, {_base("nombre_original")} as b from names),
joined as (select idx, nombre_original, b, {words} as j from based),
spelled as (select *, {_chain("j", rules.SPELLED_ACRONYMS)} as a from joined),
cut as (select *, {_split("a")} as t7 from spelled),
glued as (select *, coalesce(flatten(list_transform(t7, lambda t: {glued})), []) as t8 from cut),
whole as materialized (select *, list_transform(t8, lambda t: {stems}) as t9 from glued)"""


def typo_ctes(k: Knowledge) -> str:
    return f"""{table_of("targets", "y", [(t,) for t in k.typo_targets])},
suspects as (select distinct x from (select unnest(t9) as x from whole) where len(x) >= {S.typo_length} and x not in ({items(k.known)})),
typo_pairs as (select x, y from suspects, targets where abs(len(x) - len(y)) <= {S.typo_gap} and not (starts_with(x, y) or starts_with(y, x) or ends_with(x, y) or ends_with(y, x))),
{ratio_ctes("typo_pairs").replace("lcs", "typo_lcs").replace("ratios", "typo_ratios")},
typos as (select x, min_by(y, struct_pack(a := -r, b := y)) as y from typo_ratios where r >= {S.typo_ratio} group by x),
typo_map as (select coalesce(map(list(x), list(y)), map([]::varchar[], []::varchar[])) as m from typos),
tokened as materialized (select w.*, list_transform(t9, lambda t: coalesce(m[t], t)) as palabras from whole w, typo_map)"""


def part_ctes() -> str:
    ordered = sorted(rules.LEGAL_SUFFIXES, key=lambda s: (-len(s.split()), s))
    legal = q("^(.+?) (" + "|".join(ordered) + ")$")
    number = "'^(.*?) +([0-9]{1,4})$'"
    able = f"regexp_extract(limpio, {number}, 2) <> '' and limpio not in ({items(rules.NUMBER_BRANDS)}) and len(regexp_extract(limpio, {number}, 1)) >= 4 and regexp_matches(regexp_extract(limpio, {number}, 1), '[A-Z]') and (contains(regexp_extract(limpio, {number}, 1), ' ') or len(regexp_extract(limpio, {number}, 1)) > 4)"
    lookup = lambda table: "case t " + " ".join(f"when {q(a)} then {q(b)}" for a, b in table.items()) + " else t end"
    return f"""cleaned as (select idx, nombre_original, {_join("palabras")} as limpio from tokened),
unnumbered as (select *, len(limpio) in (30, 40) as truncado, case when {able} then regexp_extract(limpio, {number}, 1) else limpio end as sin_numero,
               case when {able} then regexp_extract(limpio, {number}, 2) else '' end as sufijo_numerico from cleaned),
unsuffixed as (select *, regexp_extract(sin_numero, {legal}, 2) as sufijo_societario,
               case when regexp_extract(sin_numero, {legal}, 2) <> '' then regexp_extract(sin_numero, {legal}, 1) else sin_numero end as core from unnumbered),
fixed as (select *, list_transform({_split("core")}, lambda t: {lookup(rules.CORRECTIONS)}) as f from unsuffixed),
parts as materialized (select * exclude (f, core), coalesce(flatten(list_transform(f, lambda t: string_split({lookup(rules.ABBREVIATIONS)}, ' '))), []) as tokens from fixed),
frequency as materialized (select token, count(*) as df from (select unnest(list_distinct(tokens)) as token from parts) group by token),
generic as (select coalesce(list(token), []) as g from frequency where df >= (select greatest({S.generic_least}, floor(count(*) * {S.generic_share}e0)) from names)),
cored as (select *, {_join("tokens")} as nucleo from parts)"""


def _gazetteer(k: Knowledge, tokens: str) -> str:
    keys, longest = items(k.employers), min(5, max(len(x.split()) for x in k.employers))
    kept = _drop(tokens, rules.STOPWORDS)
    sizes = list(range(longest, 0, -1))
    runs = f"flatten(list_transform(range(1, len({kept}) + 1), lambda i: list_transform(list_filter({sizes}, lambda n: i + n - 1 <= len({kept})), lambda n: array_to_string(({kept})[i:i + n - 1], ' '))))"
    return f"case when array_to_string({kept}, ' ') in ({keys}) then array_to_string({kept}, ' ') else list_filter({runs}, lambda r: r in ({keys}))[1] end"


def key_ctes(k: Knowledge) -> str:
    strong = [w for w, r in k.words.items() if r.weight >= S.strong_weight]
    place = lambda words: f"coalesce(list_min(list_transform([{items(words)}], lambda w: nullif(list_position(tokens, w), 0))), 0)"
    sorted_key = _join("list_sort(" + _kept(_drop("tokens", rules.STOPWORDS), "tokens") + ")")
    others = [m for m in rules.INACTIVE if m != "ESTUDIANTE"]
    jobs = f"len(tokens) > 0 and len({_drop('tokens', (*rules.OCCUPATIONS, *rules.STOPWORDS))}) = 0"
    surnames = f"len(list_filter(tokens, lambda t: t in ({items(rules.SURNAMES)})))"
    weak = f"len(list_distinct(list_filter(tokens, lambda t: t in ({items(rules.WEAK_ADDRESS)}) and not (t = 'CASA' and regexp_matches(sin_numero, {q(rules.HOUSE_OF)})))))"
    near = f"(regexp_matches(sin_numero, {q(rules.ADDRESS_NUMBER)}) or coalesce(tokens[1] in ({items(sorted({p.split()[0] for p in rules.PLACES}))}), false) or {_any('tokens', rules.PLACE_TOKENS)})"
    ph = f"(list_contains(tokens[1:2], 'PH') and sufijo_societario = '' and not {_any('tokens', (*rules.UNIT_TOKENS, *rules.STRONG_ADDRESS))})"
    plain = "replace(sin_numero, ' ', '')"
    unclassifiable = f"(regexp_matches({plain}, '^[0-9]+$') or len({plain}) >= 2 and replace({plain}, {plain}[1], '') = '')"
    student = f"(not {_phrase('sin_numero', others)} and not {_loose('tokens', others)} and student > 0 and business > 0 and business < student)"
    kind = _case([
        (f"len(sin_numero) <= 1 or regexp_matches({plain}, '^[X0]+$') or sin_numero in ({items(rules.NULL_MARKERS)}) or {unclassifiable}", "'VACIO'"),
        (f"{_phrase('sin_numero', rules.ANNOTATIONS)} or starts_with(sin_numero, {q(rules.ANNOTATION_PREFIX)})", "'ANOTACION'"),
        (_phrase("sin_numero", rules.WAITING), "'INACTIVO'"),
        (f"({_phrase('sin_numero', rules.INACTIVE)} or {_loose('tokens', rules.INACTIVE)}) and not {student}", "'INACTIVO'"),
        (f"{_phrase('sin_numero', rules.INDEPENDENT)} or {_loose('tokens', rules.INDEPENDENT)}", "'INDEPENDIENTE'"),
        (f"sufijo_societario = '' and not {ph} and g is null and not (business > 0 and (address = 0 or business < address)) and ({_any('tokens', rules.STRONG_ADDRESS)} or {weak} >= 1 and ({weak} >= 2 or {near}))", "'DIRECCION'"),
        (jobs, "'OCUPACION'"),
        (f"len(tokens) between 2 and 4 and sufijo_societario = '' and ({_any('tokens', rules.GIVEN_NAMES)} and {surnames} > 0 or {surnames} >= 2)", "'PERSONA_NATURAL'"),
    ], "'EMPRESA'")
    return f"""placed as materialized (select c.*, {_gazetteer(k, "tokens")} as g, {ph} as ph, {place(strong)} as business, {place((*rules.STRONG_ADDRESS, *rules.WEAK_ADDRESS))} as address, {place(["ESTUDIANTE"])} as student,
           len(list_filter(tokens, lambda t: not list_contains(gen, t))) = 0 as clave_generica from cored c, (select g as gen from generic)),
records as materialized (select * , case when sufijo_numerico <> '' and clave_generica then {sorted_key} || ' #' || sufijo_numerico else {sorted_key} end as clave, {kind} as tipo from placed)"""


def reduced(tokens: str) -> str:
    """Without payroll words, job titles, trailing places and stopwords; never empty."""
    a = _kept(_drop(tokens, rules.PAYROLL_WORDS), tokens)
    b = _kept(_drop(f"({a})", rules.OCCUPATIONS), f"({a})")
    text = f"regexp_replace({_join(f'({b})')}, {q('( (' + '|'.join(rules.PLACE_TOKENS) + '))+$')}, '')"
    text = f"regexp_replace({text}, {q('((^| )(' + '|'.join(rules.STOPWORDS) + '))+$')}, '')"
    return f"case when {text} = '' then {_join(tokens)} else {text} end"


def node_ctes() -> str:
    able = _kept(f"list_filter(list_distinct(tokens), lambda t: len(t) >= 2 and t not in ({items(rules.STOPWORDS)}))", "list_distinct(tokens)")
    return f"""employers as (select * from records where tipo in ({items(rules.EMPLOYER_TYPES)})),
grouped as (select clave, max(struct_pack(w := case when truncado then 0 else 1 end, l := len(limpio), t := limpio, n := nucleo)) as b, min_by(tokens, idx) as tokens, bool_or(truncado) as truncado, count(*) as n_registros from employers group by clave),
nodes as materialized (select clave, b.t as limpio, b.n as nucleo, tokens, truncado, n_registros, {reduced("string_split(b.n, ' ')")} as reducido from grouped),
rare_all as (select clave, token, coalesce(df, 1)::bigint as df from (select clave, unnest({able}) as token from nodes) left join frequency using (token)),
rare as materialized (select * from (select *, row_number() over (partition by clave order by df, token)::int as rank from rare_all) where rank <= {S.rare_tokens}),
signals as materialized (select distinct signal, clave from (
  select 'T:' || token as signal, clave from rare union all
  select 'P:' || token[1:{S.affix}], clave from rare where len(token) >= {S.affix_least} union all
  select 'S:' || right(token, {S.affix}), clave from rare where len(token) >= {S.affix_least})),
blocks as (select signal, count(*) as size from signals group by signal),
pairs as materialized (select distinct a.clave as a, b.clave as b from signals a join signals b on a.signal = b.signal and a.clave < b.clave where a.signal in (select signal from blocks where size between 2 and {S.largest_block}))"""


_SORTED = "array_to_string(list_sort(string_split({0}, ' ')), ' ')"
_CUT_OFF = "({s}.truncado and len({s}.limpio) < len({l}.limpio) and len({s}.limpio) >= 18 and len({s}.limpio) in (30, 40) and starts_with({l}.limpio, {s}.limpio))"


def decide_ctes() -> str:
    a, b = _SORTED.format("na.nucleo"), _SORTED.format("nb.nucleo")
    cut = f"({_CUT_OFF.format(s='na', l='nb')} or {_CUT_OFF.format(s='nb', l='na')})"
    low, one, none = S.accept[0], S.accept[1], S.accept[2]
    return f"""sides as materialized (select p.a, p.b, {a} as x, {b} as y, {cut} as cut_off, 200.0e0 * least(len(na.nucleo), len(nb.nucleo)) >= {low} * (len(na.nucleo) + len(nb.nucleo)) as able
  from pairs p join nodes na on na.clave = p.a join nodes nb on nb.clave = p.b),
rare_sets as (select clave, list(token) as r from rare where df < (select greatest({S.generic_least}, floor(count(*) * {S.generic_share}e0)) from names) group by clave),
scored as (select x, y from sides where able and not cut_off),
{ratio_ctes("scored")},
decided as materialized (select s.a, s.b, len(list_intersect(coalesce(ra.r, []), coalesce(rb.r, [])))::bigint as shared,
    case when cut_off then 100.0e0 when able then coalesce(t.r, 0.0e0) else 0.0e0 end as score, cut_off
  from sides s left join ratios t on t.x = s.x and t.y = s.y and able and not cut_off left join rare_sets ra on ra.clave = s.a left join rare_sets rb on rb.clave = s.b),
accepted as materialized (select a, b, shared, score, cut_off or score >= case when shared >= 2 then {low} when shared = 1 then {one} else {none} end as accepted from decided)"""


class Chain:
    """Builds whole statements from the CTEs that a query needs."""

    def __init__(self, knowledge: Knowledge | None = None, source: str = names_sql()):
        self.k = knowledge or default()
        self.steps = [clean_ctes(self.k, source), typo_ctes(self.k), part_ctes(), key_ctes(self.k), node_ctes(), decide_ctes()]

    def sql(self, depth: int, final: str, *more: str) -> str:
        """``depth``: how many of the steps; ``more``: further CTEs."""
        return "with recursive " + ",\n".join([*self.steps[:depth], *more]) + "\n" + final


CLEAN, TYPO, PARTS, RECORDS, NODES, DECIDED = range(1, 7)


def field(k: Knowledge, key: str, name: str) -> str:
    cell = lambda v: q(v) if isinstance(v, str) else str(v)
    return f"case {key} " + " ".join(f"when {q(r.key)} then {cell(getattr(r, name))}" for r in k.catalogue) + " end"


def employer(k: Knowledge, key: str, name: str) -> str:
    return f"case {key} " + " ".join(f"when {q(r.key)} then {q(getattr(r, name))}" for r in k.gazetteer) + " end"


def morphological(k: Knowledge, t: str) -> str:
    able = items(sorted(w for w, r in k.words.items() if r.weight >= S.approximate_weight))
    return f"case when len({t}) < {S.morphology_length} then '' when {t} || 'S' in ({able}) then {t} || 'S' when {t} || 'ES' in ({able}) then {t} || 'ES' when ends_with({t}, 'S') and {t}[:len({t}) - 1] in ({able}) then {t}[:len({t}) - 1] when ends_with({t}, 'ES') and {t}[:len({t}) - 2] in ({able}) then {t}[:len({t}) - 2] else '' end"


def prefix(k: Knowledge, t: str) -> str:
    return f"case when {t} in ({items(k.words)}) then '' " + " ".join(f"when starts_with({t}, {q(p[0])}) and len({t}) >= {len(p[0]) + S.prefix_extra} then {q(p[0])}" for p in rules.COMMERCIAL_PREFIXES) + " else '' end"


def phrase(k: Knowledge) -> str:
    return f"list_filter([{items(p.key for p in k.phrases)}], lambda p: contains(nucleo, p))[1]"


def cascade_ctes(k: Knowledge, source: str) -> str:
    """CTE cascade over ``source(nucleo, tokens, sufijo_societario, ...)``."""
    best = "list_max(list_transform(list_filter(list_zip(tokens, range(0, len(tokens))), lambda x: x[1] in ({w})), lambda x: struct_pack(w := {f}, i := -x[2], t := x[1]))).t".format(w=items(k.words), f=field(k, "x[1]", "weight"))
    never = items([*k.words, *k.never_approximate])
    ph = f"(list_contains(tokens[1:2], 'PH') and sufijo_societario = '' and not {_any('tokens', (*rules.UNIT_TOKENS, *rules.STRONG_ADDRESS))})"
    pick = lambda g, p, f, t, c, a: f"case when g is not null then {g} when ph then {p} when f is not null then {f} when t is not null then {t} when p is not null then {c} when ap <> '' then {a} else {{none}} end"
    prefix_field = lambda i: "case p " + " ".join(f"when {q(x[0])} then {q(x[i])}" for x in rules.COMMERCIAL_PREFIXES) + " end"
    return f"""source_rows as materialized (select row_number() over () as rid, * from {source}),
near_words as (select distinct x from (select unnest(tokens) as x from source_rows) where len(x) >= {S.morphology_length} and x not in ({never})),
{table_of("near_targets", "y", [(w,) for w in k.approximate_words])},
near_pairs as (select x, y from near_words, near_targets where 200.0e0 * least(len(x), len(y)) >= {S.approximate_ratio} * (len(x) + len(y)) and not contains(x, y)),
{ratio_ctes("near_pairs").replace("lcs", "near_lcs").replace("ratios", "near_ratios")},
near_best as (select x, min_by(y, struct_pack(a := -r, b := y)) as y from near_ratios where r >= {S.approximate_ratio} group by x),
near_all as (select w.x, case when {morphological(k, "w.x")} <> '' then {morphological(k, "w.x")} else coalesce(y, '') end as y from near_words w left join near_best using (x)),
near_map as (select coalesce(map(list(x), list(y)), map([]::varchar[], []::varchar[])) as m from near_all where y <> ''),
evidence as materialized (select s.*, {_gazetteer(k, "tokens")} as g_, {ph} as ph_, {phrase(k)} as f, {best} as t,
    list_filter(list_transform(tokens, lambda t: {prefix(k, "t")}), lambda p: p <> '')[1] as p,
    coalesce(list_filter(list_transform(tokens, lambda t: m[t]), lambda v: v is not null)[1], '') as ap from source_rows s, near_map),
evidence2 as (select * exclude (g_, ph_), g_ as gk, ph_ as phk from evidence),
cascade as materialized (select * replace (gk as gk),
    {pick(*map(q, ("gazetteer", "propiedad_horizontal", "frase", "token", "prefijo_comercial", "token_aproximado"))).format(none="'sin_evidencia'")} as nivel,
    {pick("gk", "'PH'", "f", "t", "p", "ap").format(none="''")} as evidencia,
    {pick(employer(k, "gk", "section"), "'L'", field(k, "f", "section"), field(k, "t", "section"), prefix_field(1), field(k, "ap", "section")).format(none="''")} as seccion,
    {pick(employer(k, "gk", "division"), "'68'", field(k, "f", "division"), field(k, "t", "division"), prefix_field(2), field(k, "ap", "division")).format(none="''")} as division,
    case when gk is null and not phk and f is null and t is not null then {field(k, "t", "weight")} else 5 end::int as peso
  from evidence2)""".replace("when g is not null", "when gk is not null").replace("when ph then", "when phk then")


def votes(k: Knowledge, nivel: str = "nivel", tokens: str = "tokens") -> str:
    first = f"list_filter({tokens}, lambda t: t in ({items(k.words)}))[1]"
    return f"case {nivel} " + " ".join(f"when {q(n)} then {v}" for n, v in VOTES.items()) + f" when 'token' then {field(k, first, 'weight')} end"


def marker_ctes(source: str, column: str) -> str:
    """CTE marked(x, marker): the closest marker of 88 or more."""
    return f"""{table_of("markers", "m", [(m,) for m in MARKERS])},
marker_pairs as (select x0, m, {_SORTED.format("x0")} as x, {_SORTED.format("m")} as y from (select distinct {column} as x0 from {source}), markers where 200.0e0 * least(len(x0), len(m)) >= {S.reclassify} * (len(x0) + len(m))),
{ratio_ctes("marker_pairs").replace("lcs", "marker_lcs").replace("ratios", "marker_ratios")},
marked as (select x0 as x, min_by(m, struct_pack(a := -r, b := m)) as marker from marker_pairs join marker_ratios using (x, y) where r >= {S.reclassify} group by x0)"""


def situation(text: str, tokens: str) -> str:
    return _case([(" or ".join([_loose(tokens, m), *(f"contains({text}, {q(x)})" for x in m if " " in x)]), q(label)) for label, m in rules.SITUATIONS] + [(f"starts_with({text}, {q(rules.ANNOTATION_PREFIX)})", q(rules.PREFIX_SITUATION))], "''")


def title_case(x: str) -> str:
    one = f"case when t in ({items(rules.ACRONYMS)}) or regexp_matches(t, '^[BCDFGHJKLMNPQRSTVWXYZ]{{1,4}}$') or regexp_matches(t, '^[0-9]+$') then t when i > 1 and t in ({items(rules.CONNECTORS)}) then lower(t) else upper(t[1]) || lower(t[2:]) end"
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda t, i: {one}), ' ')"


def mapped(key: str, table: dict, other: str = "null") -> str:
    return f"case {key} " + " ".join(f"when {q(a)} then {q(b) if isinstance(b, str) else repr(b)}" for a, b in table.items()) + f" else {other} end"


def guarded_ctes() -> str:
    """The guarded merge, pair after pair in a recursion: state lists hold each end's root and each root's speaker.

    CTEs fin(roots, speaker), joined_ends(clave, cluster) and disputed(kind, a, b, cohesion, ...).
    """
    return f"""
edges as (select a, b from accepted where accepted union select b, a from accepted where accepted),
reached(node, reach) as (select a, a from edges union select r.node, e.b from reached r join edges e on e.a = r.reach),
comp as materialized (select node, min(reach) as component from reached group by node),
ends as materialized (select row_number() over (order by clave) as e, dense_rank() over (order by not truncado, len(limpio), limpio) as o, n.*, component from nodes n join comp on node = clave),
queue as materialized (select row_number() over (order by score desc, p.a, p.b) as i, x.e as ea, y.e as eb from accepted p join ends x on x.clave = p.a join ends y on y.clave = p.b where p.accepted),
guard_sides as materialized (select x.e as p, y.e as q, {_SORTED.format("x.nucleo")} as x, {_SORTED.format("y.nucleo")} as y, {_SORTED.format("x.reducido")} as rx, {_SORTED.format("y.reducido")} as ry,
  len(x.limpio) >= {S.prefix_least} and starts_with(y.limpio, x.limpio) or len(y.limpio) >= {S.prefix_least} and starts_with(x.limpio, y.limpio) as prefix
  from ends x join ends y on x.component = y.component and x.e < y.e),
guard_pairs as (select x, y from guard_sides union select rx, ry from guard_sides),
{ratio_ctes("guard_pairs").replace("lcs", "guard_lcs").replace("ratios", "guard_ratios")},
guard as materialized (select p, q, case when prefix then 100.0e0 else greatest(t.r, u.r) end as c from guard_sides s join guard_ratios t on t.x = s.x and t.y = s.y join guard_ratios u on u.x = s.rx and u.y = s.ry),
orders as (select list(o order by e) as o from ends),
step(i, roots, speaker, kind, x, y, v) as (
  select 0::bigint, list(e order by e), list(e order by e), null::varchar, null::bigint, null::bigint, null::double from ends
  union all
  select i + 1, case when c >= {S.cohesion} then list_transform(roots, lambda r: case when r = y1 then x1 else r end) else roots end,
    case when c >= {S.cohesion} then list_transform(speaker, lambda s, k: case when k = x1 and o[speaker[y1]] > o[speaker[x1]] then speaker[y1] else s end) else speaker end,
    case when x1 = y1 or c >= {S.cohesion} then null when c >= {S.doubt} then 'doubt' else 'discarded' end, x1, y1, c
  from (select s.*, o.o, least(roots[ea], roots[eb]) as x1, greatest(roots[ea], roots[eb]) as y1 from step s join queue t on t.i = s.i + 1, orders o)
  left join guard on x1 <> y1 and p = least(speaker[x1], speaker[y1]) and q = greatest(speaker[x1], speaker[y1])),
fin as materialized (select roots, speaker from step order by i desc limit 1),
joined_ends as (select x.clave, y.clave as cluster from ends x, fin join ends y on y.e = fin.roots[x.e]),
disputed_pairs as (select least(roots[x], roots[y]) as px, greatest(roots[x], roots[y]) as py, max(v) as cohesion from (select kind, x, y, v from step where kind is not null), (select roots from fin) group by all having px <> py),
disputed as materialized (select case when cohesion >= {S.doubt} then 'doubt' else 'discarded' end as kind, a.clave as a, b.clave as b, cohesion, sa.limpio as representante_a, sb.limpio as representante_b,
  len(list_filter(list_distinct(list_intersect(sa.tokens, sb.tokens)), lambda t: not list_contains(g.g, t)))::int as tokens_distintivos
  from disputed_pairs d, generic g, fin f join ends a on a.e = d.px join ends b on b.e = d.py join ends sa on sa.e = f.speaker[d.px] join ends sb on sb.e = f.speaker[d.py])"""
