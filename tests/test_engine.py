"""Worked examples and invariants of the engine."""

import random

import pandas as pd
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from namesmith.functions import rules, similarity
from namesmith.functions import text as T
from namesmith.functions.similarity import lcs, ratio
from namesmith.operators import canonical, external, records, reports, resolution, sectors
from namesmith.operators.knowledge import Knowledge, default
from namesmith.plans import pipeline
from namesmith.sources import files
from namesmith.storage import Stages, durable, ship

#: raw, cleaned, number, legal form, key, type, evidence level, section + division
CASES = [
    ("'Compañía Panameña de Café, S.A.", "COMPANIA PANAMENA DE CAFE S A", "", "S A", "CAFE COMPANIA PANAMENA", "EMPRESA", "token", "I56"),
    ("'ASSA COMPA IA DE SEGUROS", "ASSA COMPANIA DE SEGUROS", "", "", "ASSA COMPANIA SEGUROS", "EMPRESA", "gazetteer", "K65"),
    ("'P H MULTIPLAZA", "PH MULTIPLAZA", "", "", "MULTIPLAZA PH", "EMPRESA", "propiedad_horizontal", "L68"),
    ("'M S CHEN LOU 7", "MINISUPER CHEN LOU 7", "7", "", "CHEN LOU MINI SUPER", "EMPRESA", "frase", "G47"),
    ("'JUB C S S", "JUB CSS", "", "", "CAJA JUB SEGURO SOCIAL", "EMPRESA", "gazetteer", "O84"),
    ("'IN DEPENDIENTE", "INDEPENDIENTE", "", "", "INDEPENDIENTE", "INDEPENDIENTE", "sin_evidencia", ""),
    ("'AMERICAN SPORTSWEARSA", "AMERICAN SPORTSWEAR SA", "", "SA", "AMERICAN SPORTSWEAR", "EMPRESA", "token", "C14"),
    ("'JUBILADACSS", "JUBILADO", "", "", "JUBILADO", "INACTIVO", "sin_evidencia", ""),
    ("'CONTRUCTORA DEL ISTMO SA", "CONSTRUCTORA DEL ISTMO SA", "", "SA", "CONSTRUCTORA ISTMO", "EMPRESA", "token", "F41"),
    ("'CASTILLERO HERMANOS", "CASTILLERO HERMANOS", "", "", "CASTILLERO HERMANOS", "EMPRESA", "sin_evidencia", ""),
    ("'CONSULTOR DE EMPRESAS", "CONSULTOR DE EMPRESAS", "", "", "CONSULTOR EMPRESAS", "EMPRESA", "token_aproximado", "M70"),
    ("'EMPRESAS MELO SA 019", "EMPRESAS MELO SA 019", "019", "SA", "EMPRESAS MELO", "EMPRESA", "gazetteer", "C10"),
    ("'SUPER 99", "SUPER 99", "", "", "99 SUPER", "EMPRESA", "gazetteer", "G47"),
    ("'JOSUE 8", "JOSUE 8", "8", "", "JOSUE", "EMPRESA", "sin_evidencia", ""),
    ("'SA", "SA", "", "", "SA", "EMPRESA", "sin_evidencia", ""),
    ("'HOTEL PLAZA HERRERA S A", "HOTEL PLAZA HERRERA S A", "", "S A", "HERRERA HOTEL PLAZA", "EMPRESA", "token", "I55"),
    ("'AVENIDA PRINCIPAL LA HACIENDA CARICUAO", "AVENIDA PRINCIPAL LA HACIENDA CARICUAO", "", "", "AVENIDA CARICUAO HACIENDA PRINCIPAL", "DIRECCION", "token", "A01"),
    ("'CASA DE EMPENO", "CASA DE EMPENO", "", "", "CASA EMPENO", "EMPRESA", "frase", "K64"),
    ("'CASA 25", "CASA 25", "", "", "25 CASA", "DIRECCION", "sin_evidencia", ""),
    ("'BANISTMO AVE PERU", "BANISTMO AVE PERU", "", "", "AVE BANISTMO PERU", "EMPRESA", "gazetteer", "K64"),
    ("'VIA TOCUMEN", "VIA TOCUMEN", "", "", "TOCUMEN VIA", "DIRECCION", "sin_evidencia", ""),
    ("'PH VERTIKAL AP 26B", "PH VERTIKAL AP 26B", "", "", "26B AP PH VERTIKAL", "DIRECCION", "sin_evidencia", ""),
    ("'PH CONSULTORES S A", "PH CONSULTORES S A", "", "S A", "CONSULTORES PH", "EMPRESA", "token", "M70"),
    ("'ALMACEN EL ESTUDIANTE", "ALMACEN EL ESTUDIANTE", "", "", "ALMACEN ESTUDIANTE", "EMPRESA", "token", "G47"),
    ("'ESTUDIANTE DE UNIVERSIDAD INTERAMERICANA", "ESTUDIANTE DE UNIVERSIDAD INTERAMERICANA", "", "", "ESTUDIANTE INTERAMERICANA UNIVERSIDAD", "INACTIVO", "frase", "P85"),
    ("'DEPENDIENTE DE SU ESPOSA", "DEPENDIENTE DE SU ESPOSA", "", "", "DEPENDIENTE ESPOSA SU", "ANOTACION", "sin_evidencia", ""),
    ("'ASISTENTE", "ASISTENTE", "", "", "ASISTENTE", "OCUPACION", "sin_evidencia", ""),
    ("'JOSE GONZALEZ", "JOSE GONZALEZ", "", "", "GONZALEZ JOSE", "PERSONA_NATURAL", "sin_evidencia", ""),
    ("'00582129864593", "00582129864593", "", "", "00582129864593", "VACIO", "sin_evidencia", ""),
    ("'XXX", "XXX", "", "", "XXX", "VACIO", "sin_evidencia", ""),
    ("'ERNST AND YOUNG", "ERNST AND YOUNG", "", "", "ERNST YOUNG", "EMPRESA", "gazetteer", "M69"),
    ("'IDAAN", "IDAAN", "", "", "ACUEDUCTOS ALCANTARILLADOS INSTITUTO NACIONALES", "EMPRESA", "gazetteer", "E36"),
    ("'REFRICAR", "REFRICAR", "", "", "REFRICAR", "EMPRESA", "prefijo_comercial", "F43"),
    ("'ACARREO RAPIDO", "ACARREO RAPIDO", "", "", "ACARREO RAPIDO", "EMPRESA", "token_aproximado", "H49"),
    ("'PANAMONTE INN AND SPA", "PANAMONTE INN AND SPA", "", "", "INN PANAMONTE SPA", "EMPRESA", "token", "I55"),
    (None, "", "", "", "", "VACIO", "sin_evidencia", ""),
]


def test_worked_examples(spark):
    ship(spark)
    names = spark.createDataFrame([(k, c[0]) for k, c in enumerate(CASES)], "idx long, nombre_original string").selectExpr("*", "1 as tokens_extra")
    rows = records.keyed(records.first_pass(names, default()), [], default())
    got = {r.idx: r for r in sectors.cascade(rows, default()).collect()}
    for k, (raw, *want) in enumerate(CASES):
        r = got[k]
        assert [r.limpio, r.sufijo_numerico, r.sufijo_societario, r.clave, r.tipo, r.nivel, r.seccion + r.division] == want, raw


@pytest.mark.parametrize("a,b,want", [("PRODUCTOS", "PRODUCTIONS", 90.0), ("HERRERA", "HERRERIA", 93.3), ("DISTRIBUTOS", "DISTRIBUIDORA", 75.0), ("", "", 100.0), ("A", "", 0.0)])
def test_ratio(a, b, want):
    assert round(ratio(a, b), 1) == want


@given(st.text("ABC ", max_size=20), st.text("ABC ", max_size=20))
def test_lcs_is_the_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    assert lcs(a, b) == row[-1] and ratio(a, b) == ratio(b, a) and 0 <= ratio(a, b) <= 100


def test_title_case(spark):
    rows = [("MINISTERIO DE OBRAS PUBLICAS", "Ministerio de Obras Publicas"), ("HSBC BANK PANAMA", "HSBC Bank Panama"), ("J M R SERVICIOS", "J M R Servicios")]
    got = spark.createDataFrame(rows, "a string, b string").select(T.title_case_es(F.col("a")).alias("x"), "b").collect()
    assert all(r.x == r.b for r in got)


def test_split_repair(spark):
    df = spark.createDataFrame([(["NU", "EZ", "Y", "NU", "EZ"],), (["SUE", "O"],), ([],)], "palabras array<string>")
    got = [r.x for r in df.select(T.merge_bigrams(F.col("palabras"), F.array(F.lit("NU EZ"))).alias("x")).collect()]
    assert got == [["NUNEZ", "Y", "NUNEZ"], ["SUE", "O"], []]
    frequency = spark.createDataFrame([("NUNEZ", 5), ("NU", 1), ("SUENO", 4), ("SUE", 9), ("AMERICANS", 5)], "token string, df long")
    tokens = spark.createDataFrame([(["NU", "EZ"],), (["SUE", "O"],), (["AMERICA", "S", "A"],)], "palabras array<string>")
    assert [r.pair for r in records.bigram_merges(tokens, frequency).collect()] == ["NU EZ"]


@pytest.mark.parametrize(
    "origin,level,weight,keys,tokens,truncated,want,band",
    [
        ("gazetteer", "gazetteer", 5, 1, 2, False, 100, "automatico"), ("reconstruccion", "token", 8, 1, 2, False, 81, "muestreo"), ("reconstruccion", "token", 7, 1, 2, False, 77, "muestreo"),
        ("reconstruccion", "token", 9, 1, 2, False, 85, "automatico"), ("reconstruccion", "token", 8, 3, 2, False, 84, "muestreo"), ("reconstruccion", "token", 8, 1, 3, True, 69, "revision"),
        ("reconstruccion", "frase", 5, 12, 3, False, 68, "revision"), ("reconstruccion", "sin_evidencia", 5, 1, 1, False, 15, "verificacion_individual"),
    ],
)
def test_confidence(spark, origin, level, weight, keys, tokens, truncated, want, band):
    df = spark.createDataFrame([(origin, level, weight, truncated, keys, ["PALABRA"] * tokens, False, "")], "origen_nombre string, nivel string, peso int, truncado boolean, n_claves int, tokens array<string>, clave_generica boolean, sufijo_numerico string")
    r = canonical.confidence(df).first()
    assert (r.confianza, r.banda) == (want, band) and len(r.factores) >= 2


def test_guarded_merge(spark):
    ship(spark)
    text = {"A": "GRUPO ALFA BETA GAMA", "B": "GRUPO ALFA BETA GAMAS", "C": "GRUPO ALFA BETAS GAMAS", "D": "OTRO NOMBRE LEJANO UNO"}
    node = spark.createDataFrame([(k, v, v, v, v.split(), False) for k, v in text.items()], "clave string, limpio string, nucleo string, reducido string, tokens array<string>, truncado boolean")
    decided = spark.createDataFrame([("A", "B", 98.0, True), ("B", "C", 97.0, True), ("C", "D", 90.0, True), ("A", "C", 80.0, False)], "a string, b string, score double, accepted boolean")
    rows = resolution.guarded_clusters(decided, node).collect()
    member = {r.a: r.b for r in rows if r.kind == "member"}
    assert member["A"] == member["B"] == member["C"] != member["D"]
    assert [r.kind for r in rows if r.kind != "member"] == ["discarded"]
    assert resolution.guarded_clusters(decided.where("false"), node).count() == 0


def test_truncation_join(spark):
    """Also where no block is useful: 200 names share all their rare tokens."""
    from namesmith.sources.files import NAMES

    head = "ASOCIACION NACIONAL DE CRIADORES DE GANADO"
    texts = [f"{head} {k:03}X" for k in range(200)] + [head[:30], head[:40], head[:20], "OTRO NOMBRE LARGO QUE NO TIENE PAR"]
    names = spark.createDataFrame([(k, "'" + t) for k, t in enumerate(texts)], NAMES)
    rows = durable(records.keyed(records.first_pass(names), [], default()), "rows")
    node = durable(resolution.nodes(rows), "nodes")
    got = {tuple(r) for r in resolution.truncation_join(node).collect()}
    ends = {r.clave: (r.limpio, r.truncado) for r in node.collect()}
    want = {(a, b) for a, (s, cut) in ends.items() for b, (l, _) in ends.items() if cut and len(s) in (30, 40) and len(l) > len(s) and l.startswith(s)}
    assert got == want and len(want) > 300
    rare = resolution.rare_tokens(node, records.document_frequency(rows))
    assert not {tuple(sorted(p)) for p in got} <= {tuple(r) for r in resolution.candidate_pairs(resolution.signals(rare)).collect()}
    assert resolution.truncation_join(node.limit(0)).count() == 0


def replayed(text, pairs):
    """Members and pairs that stay apart, pair by pair in one place."""
    from namesmith.functions.similarity import ratio

    cluster, voice, apart = {k: k for k in text}, dict(text), {}
    inside = {k: [k] for k in text}
    words = lambda t: " ".join(sorted(t.split()))
    for _, a, b in sorted((-s, a, b) for a, b, s in pairs):
        x, y = sorted((cluster[a], cluster[b]))
        if x == y:
            continue
        v, w = voice[x], voice[y]
        value = 100.0 if any(len(p) >= 18 and q.startswith(p) for p, q in ((v, w), (w, v))) else ratio(words(v), words(w))
        if value < 86:
            apart[a, b] = value
            continue
        for k in inside.pop(y):
            cluster[k] = x
            inside[x].append(k)
        voice[x] = max(v, w, key=lambda t: (len(t), t))
    best = {}
    for (a, b), value in apart.items():
        pair = tuple(sorted((cluster[a], cluster[b])))
        if pair[0] != pair[1]:
            best[pair] = max(value, best.get(pair, 0))
    rows = {("member", k, c, None) for k, c in cluster.items()}
    return rows | {("doubt" if v >= 76 else "discarded", *p, round(v, 9)) for p, v in best.items()}, voice


@pytest.mark.parametrize("shape, size, bound", [("chain", 50000, 20000), ("star", 50000, 20000), ("clique", 300, 12000), ("mixed", 400, 300)])
def test_guarded_merge_of_large_components(spark, shape, size, bound):
    ship(spark)
    rng = random.Random(size)
    word = lambda n: "".join(rng.choice("ABCDE") for _ in range(n))
    stems = [word(9) for _ in range(12)]
    text = {f"k{k:05}": f"{rng.choice(stems)} {rng.choice(stems)} {word(3)}" for k in range(size)}
    names = list(text)
    if shape == "clique":
        ends = [(a, b) for k, a in enumerate(names) for b in names[k + 1 :]]
    elif shape == "star":
        ends = [(names[0], b) for b in names[1:]]
    else:
        rng.shuffle(names)
        ends = list(zip(names, names[1:])) if shape == "chain" else [tuple(rng.sample(names, 2)) for _ in range(1200)]
    ends = sorted({(min(e), max(e)) for e in ends})
    pairs = [(a, b, float(rng.choice([85, 90, 90, 95, 100]))) for a, b in ends]
    want, voice = replayed({k: text[k] for k in sorted({k for p in ends for k in p})}, pairs)
    node = spark.createDataFrame(pd.DataFrame([(k, v, v, v, v.split(), False) for k, v in text.items()], columns=["clave", "limpio", "nucleo", "reducido", "tokens", "truncado"]), "clave string, limpio string, nucleo string, reducido string, tokens array<string>, truncado boolean")
    decided = spark.createDataFrame(pd.DataFrame([(*p, True) for p in pairs], columns=["a", "b", "score", "accepted"]), "a string, b string, score double, accepted boolean")
    got = resolution.guarded_clusters(decided, node, [stems[0]], bound).collect()
    assert {(r.kind, r.a, r.b, r.cohesion and round(r.cohesion, 9)) for r in got} == want and len(got) == len(want)
    assert len({r[0] for r in want}) == 3 and len({r[2] for r in want if r[0] == "member"}) < len(text)
    for r in got[:2000]:
        if r.kind != "member":
            assert (r.representante_a, r.representante_b) == (voice[r.a], voice[r.b])
            assert r.tokens_distintivos == len(set(voice[r.a].split()) & set(voice[r.b].split()) - {stems[0]})


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(f"{k:04}", f"{k + 1:04}") for k in range(150)] + [("x", "y"), ("z", "z")], "a string, b string")
    got = {r.node: r.component for r in resolution.components(edges).collect()}
    assert len(got) == 153 and {v for k, v in got.items() if k < "x"} == {"0000"} and got["y"] == "x"


def test_pipeline_invariants(spark):
    from namesmith.sources.names import names

    n = names(spark, "/root/testdata/sf0.001").union(spark.createDataFrame([(100001, None), (100002, ""), (100003, "'" + "LARGO " * 500)], "idx long, nombre_original string"))
    out = pipeline.run(n)
    rows = out.audit.collect()
    assert len(rows) == n.count() and all(r.macrosector and r.tipo and 0 <= r.confianza <= 100 for r in rows)
    assert all((r.seccion + r.division in rules.DIVISIONS) or not r.seccion for r in rows)
    assert pipeline.deliverable(out.audit).columns == ["nombre_original", "nombre_propuesto", "sector_propuesto", "macrosector"]


def test_empty_input(spark):
    out = pipeline.run(spark.createDataFrame([], "idx long, nombre_original string"))
    assert out.audit.count() == 0


def test_own_knowledge():
    k = Knowledge([("TIENDA", "G", "47", 8), ("PAN", "C", "10", 5), ("TIENDA", "G", "46", 6)], [("CASA DEL PAN", "Casa del Pan", "C", "10")])
    assert [r.key for r in k.catalogue] == ["TIENDA", "PAN"] and k.words["TIENDA"].division == "46" and list(k.employers) == ["CASA PAN"]


def test_external(spark):
    queue = spark.createDataFrame([(f"c{k}", f"NOMBRE {k}", 5, k) for k in range(5)], "cluster string, representante string, n_registros int, n long")
    client = lambda names: '{"resultados": [{"n": 1, "nombre_canonico": "x", "seccion": "G", "division": "47", "confianza": "alta", "motivo": "m"}, {"n": 9}]}' if "NOMBRE 0" in names else "broken"
    got = external.ask(external.batches(queue, 2), client).collect()
    assert [r.nombre for r in got] == ["NOMBRE 0"]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c\n d '), (2, None)], "idx long, nombre_original string")
    assert {r.idx: r.nombre_original for r in files.csv_round_trip(df).collect()} == {1: 'a "b", c\n d ', 2: ""}
    assert files.export_csv(df, str(tmp_path / "x.csv"), 5) == 2
    with pytest.raises(ValueError):
        files.export_csv(df, str(tmp_path / "y.csv"), 1)
    assert files.read_optional(spark, str(tmp_path / "none"), files.NAMES).count() == 0
    df.write.parquet(str(tmp_path / "n.parquet"))
    assert files.read_names(spark, str(tmp_path / "n.parquet")).count() == 2
    with pytest.raises(ValueError):
        files.read_names(spark, str(tmp_path / "n.parquet"), "otro")


def test_lcs_of_batches():
    r = random.Random(4)
    word = lambda: "".join(r.choice("ABCÑ ") for _ in range(r.choice([0, 1, 5, 30, 63, 64, 65, 90])))
    a, b = [word() for _ in range(400)], [word() for _ in range(400)]
    assert similarity.lcs_all(a, b).tolist() == [lcs(x, y) for x, y in zip(a, b)]
    assert similarity.ratios(a, b).tolist() == [ratio(x, y) for x, y in zip(a, b)]
    assert similarity.lcs_all([], []).tolist() == []
    values = sorted({w for w in b if w})
    got = similarity.best_match(a, values, 60.0)
    for t in a:
        best = max(values, key=lambda v: (ratio(t, v), [-ord(c) for c in v]))
        assert got[t] == (min(v for v in values if ratio(t, v) == ratio(t, best)) if ratio(t, best) >= 60.0 else "")


def test_null_ratio(spark):
    df = spark.createDataFrame([("A", None), (None, None), ("A", "A")], "a string, b string")
    assert [r.x for r in df.select(similarity.indel_ratio(F.col("a"), F.col("b")).alias("x")).collect()] == [None, None, 100.0]


def test_no_length_caps(spark):
    """Names of any length: pairs beyond word 1000, letters beyond 1000, more than four trailing stopwords."""
    long = " ".join(["PALABRA"] * 1200 + ["NU", "EZ"])
    words = spark.createDataFrame([(1, long.split())], "idx long, palabras array<string>")
    frequency = spark.createDataFrame([("NUNEZ", 5)], "token string, df long")
    merges = records.bigram_merges(words, frequency)
    assert [r.pair for r in merges.collect()] == ["NU EZ"]
    assert records.joined_words(words, merges).first().palabras[-1] == "NUNEZ"
    token = "A" + "B" * 3000
    rows = spark.createDataFrame([(token,)], "a string").select(T.title_case_es(F.col("a")).alias("x")).collect()
    assert rows[0].x == token.capitalize()
    stop = spark.createDataFrame([(["FERRETERIA", "DE", "LA", "Y", "DE", "LA", "Y"],)], "t array<string>")
    assert stop.select(T.remove_qualifiers(F.col("t")).alias("x")).first().x == ["FERRETERIA"]


def test_graphs_of_any_size(spark):
    edges = spark.createDataFrame([(f"{k:04}", f"{k + 1:04}") for k in range(60)] + [("x", "y"), ("z", "z")], "a string, b string")
    small, large = ({tuple(r) for r in resolution.components(edges, small=n).collect()} for n in (1000, 0))
    assert small == large and len(small) == 63


def test_places_by_ranges(spark):
    df = spark.range(1000).selectExpr("id % 7 as n", "cast(id as string) as cluster").repartition(5)
    got = resolution.numbered(df, "rank", 1, F.desc("n"), "cluster").collect()
    assert [(r.n, r.cluster) for r in sorted(got, key=lambda r: r["rank"])] == sorted(((r.n, r.cluster) for r in got), key=lambda x: (-x[0], x[1]))
    assert sorted(r["rank"] for r in got) == list(range(1, 1001))
    assert resolution.numbered(df.limit(0), "rank", 1, "n").count() == 0


def test_sheets(spark, tmp_path):
    from namesmith.sources import sheets

    texts = ["'A & <B>", None, " blanks ", "línea\notra", "\x01x", "Ñandú 日本", "12"] * 5
    df = spark.createDataFrame([(t, k, k / 2, k % 2 == 0) for k, t in enumerate(texts)], "nombre_original string, n long, x double, b boolean").coalesce(1)
    path = str(tmp_path / "book.xlsx")
    assert sheets.write_xlsx(df, "file://" + path, "ORIGINAL", limit=10) == 35  # nine rows and a header a sheet
    first = list(sheets.sheet_rows(open(path, "rb").read(), "ORIGINAL"))
    assert len(first) == 10 and first[0] == ["nombre_original", "n", "x", "b"] and first[1] == ["'A & <B>", "0", "0.0", "True"] and first[2][0] is None
    names = ["ORIGINAL", *(f"ORIGINAL_{k}" for k in (2, 3, 4))]
    got = [r[0] for n in names for r in list(sheets.sheet_rows(open(path, "rb").read(), n))[1:]]
    assert got == [t and t.replace("\x01", "") for t in texts]
    rows = sheets.read_xlsx(spark, "file://" + path, sheet="ORIGINAL_2").orderBy("fila").collect()
    assert [r.texto for r in rows] == [(t or "").replace("\x01", "") for t in texts[9:18]] and [r.fila for r in rows] == list(range(9))
    with pytest.raises(Exception, match="expected"):
        sheets.read_xlsx(spark, "file://" + path, "otro").collect()


def test_shared_strings():
    """A workbook as other writers make it: shared strings, rich text, gaps between cells."""
    import io
    import zipfile

    from namesmith.sources import sheets

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="H" sheetId="1" r:id="a"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="a" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>uno</t></si><si><r><t>d</t></r><r><t>os</t></r></si></sst>")
        z.writestr("xl/worksheets/s.xml", f'<worksheet {main}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="B2"><v>5</v></c></row><row/></sheetData></worksheet>')
    assert list(sheets.sheet_rows(book.getvalue(), "H")) == [["uno", None, "dos"], [None, "5"], []]
    with pytest.raises(ValueError):
        list(sheets.sheet_rows(book.getvalue(), "otra"))


def test_stages_resume(spark, tmp_path, caplog):
    from namesmith.storage import Phase, Stages

    made = []

    def make():
        made.append(1)
        return spark.range(3)

    folder = "file://" + str(tmp_path)
    assert Stages(spark, folder, "v1")("a", make).count() == 3 and Stages(spark, folder, "v1")("a", make).count() == 3 and len(made) == 1
    assert Stages(spark, folder, "v2")("a", make).count() == 3 and len(made) == 2
    (tmp_path / "v1" / "a" / "_SUCCESS").unlink()  # as a run that died leaves it
    assert Stages(spark, folder, "v1")("a", make).count() == 3 and len(made) == 3
    with caplog.at_level("INFO", "namesmith"), pytest.raises(KeyError), Phase("x"):
        raise KeyError
    assert "begin x" in caplog.text and "FAILED x" in caplog.text


def test_pipeline_resumes(spark, tmp_path):
    n = spark.createDataFrame([(k, c[0]) for k, c in enumerate(CASES)], "idx long, nombre_original string")
    folder = "file://" + str(tmp_path)
    first, again = (pipeline.run(n, folder=folder).audit.drop("factores").toPandas().sort_values("idx").astype(str) for _ in range(2))
    assert first.reset_index(drop=True).equals(again.reset_index(drop=True)) and (tmp_path / "all" / "merged" / "_SUCCESS").exists()


def test_prompt_and_json(tmp_path):
    k = Knowledge([("TIENDA", "G", "47", 8), ("PAN", "C", "10", 5), ("BODEGA", "G", "47", 6)], [("CASA DEL PAN", "Casa del Pan", "C", "10")])
    got = external.prompt_catalogue(k.catalogue)
    assert [g[:2] for g in got] == [("C", "10"), ("G", "47")] and all(g[2] for g in got) and len(external.prompt_text(k.catalogue).split("\n")) == 2
    assert files.read_json(str(tmp_path / "none.json"), {"a": 1}) == {"a": 1}


def test_shared_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    from namesmith.storage import shared_folder

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(RuntimeError):
        shared_folder(session)


def test_upper_median(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,)], "v int")
    assert reports.upper_median(df, "v").first().mediana == 3


def test_upper_median_by_selection(spark):
    rng = random.Random(9)
    wide = spark.range(3_000_000).select(F.when(F.col("id") % 11 != 0, F.exp(F.rand(3) * 600 - 300)).alias("v"))
    few = reports.upper_median(wide, "v", 1000).first().mediana
    below, equal, n = wide.agg(F.count_if(F.col("v") < few), F.count_if(F.col("v") == few), F.count("v")).first()
    assert below <= n // 2 < below + equal
    for kind, values in (("int", [1, 2] * 300 + [3]), ("int", [7] * 900), ("double", [rng.choice([0.5, -0.0, 1e300, float("nan"), None]) for _ in range(999)]), ("bigint", [rng.randrange(10**15) for _ in range(2001)]), ("string", [])):
        known = sorted(v for v in values if v is not None and v == v)
        got = reports.upper_median(spark.createDataFrame([(v,) for v in values], f"v {kind}"), "v", 10).first().mediana
        assert got == (known[len(known) // 2] if known else None)


def test_counters_in_one_pass(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", None, "x"), (None, 1, "x")], "k string, n int, z string")
    out = reports.counters(df, {"k": F.col("k"), "n": F.col("n"), "z": F.col("z")})
    got = {(r.dimension, r.valor): (r.n, r.porcentaje) for r in out.collect()}
    assert got == {("total", None): (4, 100.0), ("k", "a"): (2, 50.0), ("k", "b"): (1, 25.0), ("k", None): (1, 25.0), ("n", "1"): (2, 50.0), ("n", "2"): (1, 25.0), ("n", None): (1, 25.0), ("z", "x"): (3, 75.0), ("z", None): (1, 25.0)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_figures_of_stages(spark, tmp_path, caplog):
    stages = Stages(spark, f"file://{tmp_path}", "1")
    with caplog.at_level("INFO", "namesmith"):
        stages("t", lambda: spark.range(7), pares=F.count_if(F.col("id") % 2 == 0))
    assert {k: stages.figures["t"][k] for k in ("filas", "pares")} == {"filas": 7, "pares": 4} and "'pares': 4" in caplog.text
    again = Stages(spark, f"file://{tmp_path}", "1")
    assert again("t", lambda: 1 / 0).count() == 7 and again.reused == ["t"] and not again.figures


def test_fold_is_the_decomposition(spark):
    import unicodedata

    r = random.Random(3)
    texts = ["ﬁn ½ Ａ１ ẹ́ ㎏ ™ ǅ 𝐀𝟗 Œ Łódź ﷺ ㈱ ¼", "", *("".join(chr(r.choice((r.randrange(32, 127), r.randrange(128, 0x600), r.randrange(0x1E00, 0x3400), r.randrange(0xF900, 0x10000), r.randrange(0x1D400, 0x1F200)))) for _ in range(40)) for _ in range(300))]
    # Characters whose capital is another matter (in Java's Unicode version, too) are left out.
    texts = ["".join(c for c in t if c in "ﬁ" or len(c.upper()) == 1 and not 0xD800 <= ord(c) < 0xE000 and not (not c.isascii() and c.upper().isascii())) for t in texts]

    def plain(t):
        t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).upper()
        return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in t).split())

    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.collapse_spaces(T.keep_charset(T.fold_accents(F.col("t")))).alias("x")).collect()
    assert [g.x for g in got] == [plain(g.t) for g in got]
    assert got[0].x.startswith("FIN 1 2 A1 E KG TM DZ A9")
