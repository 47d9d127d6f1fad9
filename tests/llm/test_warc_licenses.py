import hashlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from namesmith.llm import licenses, registry, warc

PAGES = [(1, "http://a/\r\nx", "a" * 999), (2, "http://b/", "b" * 1000), (3, None, "b" * 1000), (4, "u", "é" * 200_000), (9, "u", "é" * 200_000), (5, "u", None), (6, "u", ""), (7, "u", "a" * 999), (None, "u", "b" * 1000), (None, "u", "\r\n\r\n" * 500), (8, "u", "\r\n\r\n" * 500), (10, "u", "c" * 65536), (11, "u", "d" * 65537), (12, "r", "e" * 2000), (12, "r", "e" * 2000)]


def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as size", "2 as key", "3 as first").repartition(4)


def test_round_trip(spark):
    want = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        refers = max(same) if len(body) >= 1000 and max(same) != i else None
        want.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if refers is not None else "response", refers))
    got = [tuple(r) for r in warc.round_trip(pages(spark)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert warc.round_trip(pages(spark).limit(0)).count() == 0


def test_chunks_are_records(spark):
    rows = warc.records(pages(spark)).collect()
    assert max(len(r["data"]) for r in rows) <= warc.CHUNK + 1000
    by = {}
    for r in sorted(rows, key=lambda r: r["chunk"]):
        by.setdefault(r["record"], []).append(r)
    for own in by.values():
        data = b"".join(r["data"] for r in own)
        head, _, rest = data.partition(b"\r\n\r\n")
        length = int(warc.parsed(head)["content-length"])
        assert rest[length:] == b"\r\n\r\n" and [r["chunk"] for r in own] == list(range(own[0]["chunks"]))


@pytest.mark.parametrize("harm", ["flip", "drop"])
def test_damage_is_found(spark, harm):
    rows = [r.asDict() for r in warc.records(pages(spark)).collect()]
    large = [r for r in rows if r["chunks"] > 2]
    if harm == "flip":
        large[1]["data"] = b"X" + bytes(large[1]["data"])[1:]
    else:
        rows.remove(large[1])
    with pytest.raises(Exception, match="damaged|out of order|ends early"):
        warc.read(spark.createDataFrame(rows, warc._ROWS)).collect()


DOCUMENTS = [(1, "intro\nReleased under the MIT License.\nmore text here"), (2, "released UNDER the mit license"), (3, None), (4, ""), (5, "All rights reserved.\nLicensed under CC BY-NC 4.0."), (6, "word"), (None, "Licensed under the Apache License, Version 2.0!"), (1, "This work is licensed under the GNU General Public License, version 3."), (7, "a b " * 20000), (8, "line\n" * 5000 + "Released under the MIT License."), (2, "released UNDER the mit license"), (9, "Ärger — Released under thé MIT License")]


def test_licenses_against_sql(spark):
    df = spark.createDataFrame(DOCUMENTS, "doc_id long, text string").selectExpr("*", "1 as license", "2 as score", "3 as hits")
    got = sorted(map(tuple, licenses.scan(df).collect()), key=str)
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([d for d, _ in DOCUMENTS], pa.int64()), "text": [t for _, t in DOCUMENTS]}))
    want = sorted(con.execute(licenses.oracle()).fetchall(), key=str)
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert all(abs(g[2] - w[2]) < 1e-12 for g, w in zip(got, want))
    assert dict((r[0], r[1]) for r in got)[5] == "CC-BY-NC-4.0" and dict((r[0], r[1]) for r in got)[8] == "MIT"
    assert licenses.scan(df.limit(0)).count() == 0


def test_oracles_run(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    for name, sql in registry.ORACLES.items():
        want = con.execute(sql).df()
        got = registry.QUERIES[name](spark, "/root/testdata/sf0.001").toPandas()[list(want.columns)]
        key = lambda df: sorted(map(str, df.astype(object).where(df.notna(), None).itertuples(index=False)))
        assert key(got.convert_dtypes()) == key(want.convert_dtypes()), name


def test_licenses_over_line_breaks_and_inside_lines(spark):
    mit = "The MIT License (MIT)\n\nCopyright (c) 2020 A. Person. All rights reserved.\n\n" + licenses.bodies()["MIT-text"]
    notice = licenses.TEMPLATES["GPL-3.0-notice"].split()
    embedded = "lorem ipsum dolor sit amet " * 300
    cases = [
        (1, mit, "MIT-text"),
        (2, " ".join(mit.split()), "MIT-text"),
        (3, embedded + " ".join(mit.split()) + embedded, "MIT-text"),
        (4, "\n".join(" ".join(notice[i : i + 6]) for i in range(0, len(notice), 6)), "GPL-3.0-notice"),
        (5, embedded + "Released under the MIT License. " + embedded, "MIT"),
        (6, licenses.bodies()["BSD-3-Clause-text"].replace("\n", "\r\n * "), "BSD-3-Clause-text"),
        (7, "x\n" * 3000 + licenses.bodies()["GPL-3.0-text"], "GPL-3.0-text"),
        (8, embedded, None),
        (9, "to any person obtaining a copy of this software " + embedded, None),
    ]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame([c[:2] for c in cases], "doc_id long, text string")).collect()}
    assert {d: r.license for d, r in got.items()} == {d: name for d, _, name in cases}
    assert all(got[d].score == 1.0 for d in (1, 2, 3, 4, 5, 7)) and got[5].n_lines == 0


def test_windows_by_definition():
    import random

    r = random.Random(3)
    templates = {"p": "a b c d e", "q": "a b a b c a"}
    known = licenses.Templates({}, templates, 0.5)
    for _ in range(400):
        words = r.choices("abcdez", k=r.randint(0, 30))
        best = (0.0, "")
        for name, text in templates.items():
            size, b = len(text.split()), set(licenses.bigrams_of(text))
            for k in range(max(len(words) - size, 0) + 1):
                a = set(licenses.bigrams_of(" ".join(words[k : k + size])))
                if known.low * len(b) <= len(a) <= known.high * len(b):
                    best = min(best, (-2 * len(a & b) / (len(a) + len(b)), name))
        raw = "\n".join(words).encode()
        ((t, dice, lines),) = known.scan(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert (dice, t if t is None else known.names[t], lines) == ((-best[0], best[1], 0) if -best[0] >= 0.5 else (0.0, None, 0))
