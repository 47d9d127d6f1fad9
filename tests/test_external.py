"""Answers of a client: retries, malformed and short answers, repeated numbers, a cache that loads may be put into again."""

import json

from namesmith.operators import external


def queue(spark, names, size=2):
    return external.batches(spark.createDataFrame(list(enumerate(names)), "n long, representante string"), size)


def test_retries_end(spark):
    def client(names):
        tried.append(names)
        if names[0] == "BAD" or len(tried) % 3:
            raise OSError("down")
        return json.dumps({"resultados": [{"n": 1, "seccion": "G", "division": "47"}]})

    tried = []
    raw = external.asked(queue(spark, ["GOOD", "BAD"], 1).coalesce(1), client, wait=0).orderBy("lote").collect()
    assert [(r.nombres, r.intentos, r.respuesta is None, r.error) for r in raw] == [(["GOOD"], 3, False, None), (["BAD"], 3, True, "OSError: down")]
    assert external.asked(queue(spark, []), client).count() == 0


def test_answers(spark):
    answers = {
        "A": {"resultados": [{"n": 2, "seccion": "C", "division": 10}, {"n": 2, "seccion": "G"}, {"n": 3}, {"n": 0}, {"n": None}, {"n": "one"}, None, 7, "x"]},
        "C": {"resultados": {"n": 1}},
        "E": ["x"],
        "G": {"other": 1},
        "I": {"resultados": [{"n": 1, "seccion": None}, {"n": 2, "nombre_canonico": "j\n\"é", "extra": 1}]},
    }
    names = list("ABCDEFGHI") + [None]
    got = external.ask(queue(spark, names), lambda names: json.dumps(answers[names[0]]), wait=0)
    assert got.columns == external._names(external.ANSWER)
    assert sorted(tuple(r) for r in got.collect()) == [("", 'j\n"é', "", "", "", ""), ("B", "", "C", "10", "", ""), ("I", "", "", "", "", "")]
    raw = external.asked(queue(spark, names), lambda names: json.dumps(answers[names[0]]))
    log = [(r.pedidos, r.respondidos, r.estado) for r in external.answer_log(raw).orderBy("lote").collect()]
    assert log == [(2, 1, "parcial"), (2, 0, "malformada"), (2, 0, "malformada"), (2, 0, "malformada"), (2, 2, "completa")]


def test_a_batch_stays_whole(spark):
    """A batch is one call however Arrow cuts the rows."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        raw = external.asked(queue(spark, [f"N{k:03d}" for k in range(100)], 40), lambda names: str(len(names))).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert sorted((r.lote, r.respuesta, r.nombres[0]) for r in raw) == [(0, "40", "N000"), (1, "40", "N040"), (2, "20", "N080")]


def test_cache(spark, tmp_path):
    cache = f"file://{tmp_path}/cache"
    assert external.remembered(spark, cache).count() == 0
    rows = lambda *pairs: spark.createDataFrame([(n, n, s, "47", "alta", "") for n, s in pairs], external.ANSWER)
    external.remember(rows(("A", "G"), ("B", "G")), cache, "1")
    external.remember(rows(("B", "C"), ("C", "C")), cache, "2")
    external.remember(rows(("B", "C"), ("C", "C")), cache, "2")
    assert sorted((r.nombre, r.seccion) for r in external.remembered(spark, cache).collect()) == [("A", "G"), ("B", "G"), ("C", "C")]
    external.remember(rows(("A", "K")), cache, "1")
    assert sorted((r.nombre, r.seccion) for r in external.remembered(spark, cache).collect()) == [("A", "K"), ("B", "C"), ("C", "C")]
