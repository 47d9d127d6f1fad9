"""Employer names for tests and benchmarks: one formula over integer keys, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ACTIVITIES = (
    "FERRETERIA", "CONSTRUCTORA", "RESTAURANTE", "HOTEL", "TALLER", "FARMACIA", "ESCUELA", "TRANSPORTE", "DISTRIBUIDORA",
    "INVERSIONES", "GRUPO", "SERVICIOS", "CLINICA", "BUFETE", "MINI SUPER", "ALMACEN", "PRODUCTOS", "IMPORTADORA", "CAFE",
    "LAVANDERIA", "CONTRUCTORA", "DIST", "INMOBILIARIA", "VETERINARIA", "BANCO", "REFRICAR", "ACARREO", "MS", "COMPAÑIA DE SEGUROS", "",
)
FIRST = (
    "ANDES", "ISTMO", "PACIFICO", "LUNA", "ESTRELLA", "AURORA", "BAMBU", "CEIBA", "CORAL", "DELTA", "ESMERALDA", "FENIX",
    "GALAXIA", "HALCON", "IMPERIAL", "JADE", "KARIBE", "LAGUNA", "MIRADOR", "NORTE", "OASIS", "PALMA", "QUETZAL", "RUBI",
    "SIRENA", "TITAN", "UNION", "VALLE", "XENON", "YATE", "ZAFIRO",
)
SECOND = ("BELLAVISTA", "CENTRAL", "DORADO", "EUROPEO", "FAMILIAR", "GENERAL", "HERMANOS", "INDUSTRIAL", "JUVENIL", "LIDER", "MODERNO", "NACIONAL", "ORIENTAL", "PREMIUM", "REAL", "SUPREMO", "TROPICAL")
FORMS = ("", " S A", " SA", " INC", "", " S.A.", " CORP", "", " S DE R L", "", " LTDA")
PLACES = ("PANAMA", "COLON", "DAVID", "CHITRE")
SPECIAL = (
    "'Compañía Panameña de Café, S.A.", "'ASSA COMPA IA DE SEGUROS", "'P H MULTIPLAZA", "'M S CHEN LOU 7", "'JUB C S S", "'IN DEPENDIENTE",
    "'AMERICAN SPORTSWEARSA", "'JUBILADACSS", "'CASTILLERO HERMANOS", "'CONSULTOR DE EMPRESAS", "'EMPRESAS MELO SA 019", "'SUPER 99", "'JOSUE 8",
    "'SA", "'AVENIDA PRINCIPAL LA HACIENDA CARICUAO", "'CASA DE EMPENO", "'CASA 25", "'BANISTMO AVE PERU", "'VIA TOCUMEN", "'PH VERTIKAL AP 26B",
    "'PH CONSULTORES S A", "'ALMACEN EL ESTUDIANTE", "'ESTUDIANTE DE UNIVERSIDAD INTERAMERICANA", "'ESPERANDO NOMBRAMIENTO EN EL MIN DE EDUCACION",
    "'DEPENDIENTE DE SU ESPOSA", "'INDEPENDIENTE AGRIMENSURA", "'AMA DE CASA ACTUALMENTE NO TRABAJA", "'ASISTENTE", "'JOSE GONZALEZ", "'00582129864593",
    "'XXX", "'AUTORIDAD DEL CANAL DE PANAMA ESCLUSAS", "'CORPORACION BELLAVISTA DE FINANZAS SA", "'ERNST AND YOUNG", "'IDAAN", "'PRODUCTOS OCEANOS",
    "'INSTITUTO ONCOLOGICO NACIONAL", "'TRICOM", "'CAJA DE SEGURO SCOIAL", "'BOUTIQUE Y SPA", "", "'NO APLICA", "'R P", "'CLIENTE FALLECIDO", "'NU EZ Y ASOCIADOS",
    "'NUNEZ MODA", "'NUNEZ Y CIA", "'TALLER NUNEZ", "'UNIVERSIDAD TECNOLOGICA PENONOME", "'DISE O GRAFICO LUNA", "'HOSPITAL ANALISTA CHITRE", "'MENOR DE EDAD", "'FERRETERIA CASA CENTRAL",
)

#: (key column, table): which driver table numbers the names.
KEYS = {"customer": "c_custkey", "orders": "o_orderkey", "supplier": "s_suppkey"}


def _expression(at, mod, div, concat) -> str:
    """The name of key k, written with each engine's own list access, remainder and division."""
    lit = lambda values: "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"
    pick = lambda values, i: at(lit(values), f"({mod(i, len(values))}) + 1")
    e = mod("k * 7919", 997)
    base = concat(pick(ACTIVITIES, f"({e})"), "' '", pick(FIRST, f"({e}) * 5"), f"case when {mod(f'({e})', 3)} = 0 then '' else ' ' end", f"case when {mod(f'({e})', 3)} = 0 then '' else {pick(SECOND, f'({e}) * 3')} end")
    number = f"cast({mod('k', 90)} + 1 as varchar(9))"
    return f"""case when {mod("k", 17)} = 0 then {pick(SPECIAL, div("k", 17))}
    when {mod("k", 13)} = 1 then {concat("''''", f"replace({base}, 'ER', 'RE')", pick(FORMS, "k"))}
    when {mod("k", 13)} = 2 then {concat("''''", f"substring({concat(base, pick(FORMS, 'k'), _quoted(' INTERNACIONAL DEL ISTMO'))}, 1, 30)")}
    when {mod("k", 13)} = 3 then {concat("''''", base, pick(FORMS, "k"), "' '", number)}
    when {mod("k", 13)} = 4 then {concat("''''", base, "' '", pick(PLACES, "k"))}
    when {mod("k", 13)} = 5 then {concat("''''", f"replace({base}, 'AL', 'L')", pick(FORMS, "k"))}
    else {concat("''''", base, pick(FORMS, "k"))} end"""


def _quoted(text: str) -> str:
    return "'" + text + "'"


def spark_expression() -> str:
    at = lambda values, i: f"element_at(array({values[1:-1]}), cast({i} as int))"
    escaped = _expression(at, lambda a, b: f"({a}) % {b}", lambda a, b: f"({a} div {b})", lambda *p: "concat(" + ", ".join(p) + ")")
    return _spark_quotes(escaped)


def _spark_quotes(sql: str) -> str:
    """SQL doubles a quote inside a literal; Spark's default literals take a backslash."""
    out, inside, i = [], False, 0
    while i < len(sql):
        if sql[i] == "'" and inside and sql[i : i + 2] == "''":
            out.append("\\'")
            i += 2
            continue
        if sql[i] == "'":
            inside = not inside
        out.append(sql[i])
        i += 1
    return "".join(out)


def duckdb_expression() -> str:
    return _expression(lambda values, i: f"({values})[{i}]", lambda a, b: f"({a}) % {b}", lambda a, b: f"({a} // {b})", lambda *p: "(" + " || ".join(p) + ")")


def names(spark: SparkSession, sf_dir: str, table: str = "customer") -> DataFrame:
    """``(idx, nombre_original)`` for each key of a driver table."""
    key = KEYS[table]
    keys = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(F.col(key).cast("long").alias("k"))
    return keys.select(F.col("k").alias("idx"), F.expr(spark_expression()).alias("nombre_original"))


def names_sql(table: str = "customer") -> str:
    key = KEYS[table]
    return f"select k as idx, {duckdb_expression()} as nombre_original from (select {key}::bigint as k from {table})"


#: Names that drift: three of a chain, with so many letters of a word replaced. The first two are alike and so are the
#: last two, but the ends aren't: of a chain's last pair a guarded merge doubts, discards or accepts, chain after chain.
_DRIFT, _REPLACED = "MANANTIALESCLAROS", (10, 6, 0, 15, 9, 0, 4, 2, 0)


def _drifting(concat, mod, div) -> str:
    replaced = f"case {mod('k', len(_REPLACED))} " + " ".join(f"when {i} then {n}" for i, n in enumerate(_REPLACED)) + " end"
    chain = f"substring(md5(cast({div('k', 3)} as varchar(9))), 1, 8)"
    return concat(_quoted("''CORDILLERAS NODO"), chain, "' NUDO'", chain, "' '", f"substring('{_DRIFT}', 1, {len(_DRIFT)} - ({replaced}))", f"repeat('Z', {replaced})")


def drifting_names(spark: SparkSession, sf_dir: str, table: str = "supplier") -> DataFrame:
    """``(idx, nombre_original)``, idx below 0, for each key of a driver table: chains for clustering under its guard."""
    keys = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(F.col(KEYS[table]).cast("long").alias("k"))
    text = _spark_quotes(_drifting(lambda *p: "concat(" + ", ".join(p) + ")", lambda a, b: f"({a}) % {b}", lambda a, b: f"({a} div {b})"))
    return keys.select((-F.col("k")).alias("idx"), F.expr(text).alias("nombre_original"))


def drifting_sql(table: str = "supplier") -> str:
    text = _drifting(lambda *p: "(" + " || ".join(p) + ")", lambda a, b: f"({a}) % {b}", lambda a, b: f"({a} // {b})")
    return f"select -k as idx, {text} as nombre_original from (select {KEYS[table]}::bigint as k from {table})"


#: What makes names longer than a field, and the lengths that fields cut them to.
_TAIL, _FIELDS = " SOCIEDAD INTERNACIONAL DEL ISTMO CENTROAMERICANO", (30, 40)


def _cut(source: str, take: str, rest: str) -> str:
    whole = f"select idx, {take} as nombre_original from ({source})"
    cuts = [f"select -{rest.format(n=n + 1)} as idx, substring({take}, 1, {n + 1}) as nombre_original from ({source}) where idx % {k} = 0" for k, n in zip((3, 5), _FIELDS)]
    return " union all ".join([whole, *cuts])


def cut_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(idx, nombre_original)``: the names made longer, and a third of them again as each field cuts them, idx below 0."""
    names(spark, sf_dir).createOrReplaceTempView("namesmith_names")
    return spark.sql(_cut("namesmith_names", f"concat(nombre_original, '{_TAIL}')", "(idx * 100 + {n})").replace("from (namesmith_names)", "from namesmith_names"))


def cut_sql() -> str:
    return _cut(names_sql(), f"nombre_original || '{_TAIL}'", "(idx * 100 + {n})")
