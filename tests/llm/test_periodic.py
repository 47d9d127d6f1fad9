import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from namesmith.llm import periodic
from namesmith.llm.registry import QUERIES
from namesmith.llm.runtime import table

SF = "/root/testdata/sf0.001"


def brute(w):
    """Every run by comparing each word with the one a period later, periods checked to be the smallest."""
    n, found = len(w), set()
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(12, 2 * p) and not any(all(w[x] == w[x + q] for x in range(i, j + p - q)) for q in range(1, p)):
                found.add((i, j + p, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda x: (x[0], x[2]))


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    gone = {i for s, e, p in found for i in range(s + p, e)}
    listing = "".join(f"{s},{e - s},{p}\n" for s, e, p in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    best = min(found, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    first = (None,) * 4 if best is None else (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    return (len(found), *first, *(hashlib.sha256(x.encode()).hexdigest() for x in (listing, kept)))


def numbers(words):
    seen = {}
    return np.array([seen.setdefault(x, len(seen)) for x in words], np.int64)


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_runs_against_brute_force(letters):
    rng = random.Random(letters)
    for _ in range(120):
        w = [rng.randrange(letters) for _ in range(rng.randint(1, 90))]
        if rng.random() < 0.6:
            a = rng.randrange(len(w))
            p = 1 + (len(w) - a) // rng.randint(3, 10)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        assert [tuple(map(int, r)) for r in periodic.runs(numbers(w), len(w) // 2)] == brute(w), w


def test_long_periods_and_extensions():
    rng = random.Random(5)
    w = [rng.randrange(3) for _ in range(300)]
    w = w + w + w[:77]
    assert [tuple(map(int, r)) for r in periodic.runs(numbers(w), len(w) // 2)] == brute(w)
    s = numbers(w)
    lce = periodic.Extensions(s)
    a, b = np.array([0, 5, 1, 676, 0]), np.array([300, 305, 2, 3, 600])
    want = [next((k for k in range(len(w)) if max(x, y) + k >= len(w) or w[x + k] != w[y + k]), 0) for x, y in zip(a, b)]
    assert lce.of(a, b).tolist() == want
    many = np.arange(200000) % 700  # a long text: one run, few arrays
    assert periodic.runs(many, 100000).tolist() == [[0, 200000, 700]]


def test_whole_table(spark):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    short = [r for r in rows if len((r.text or "").split()) < 400]  # brute force is cubic
    assert len(short) > len(rows) // 2 and sum(zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in short) > 3
    for r in short:
        assert got[r.doc_id] == expected(r.doc_id, r.text), r.doc_id


def test_odd_rows(spark):
    hot = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 10 == 0)
    texts = [None, "", " \t\n", "a", "a " * 12, "a b " * 6 + "c " * 30, "x y\x85z " * 14, "é b é " * 9, " ".join(map(str, range(50))), "a " * 11]
    rows = [(d, t, "x", 1) for d in (1, hot, None) for t in texts] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, period long").repartition(3)
    got = sorted(map(str, (tuple(r) for r in periodic.periodic_runs(docs).collect())))
    assert got == sorted(str((d, *expected(d, t))) for d, t, _, _ in rows)
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
    spans = {tuple(r) for r in periodic.run_spans(docs.where("doc_id = 1")).collect()}
    assert {(1, 0, 12, 1), (1, 12, 30, 1), (1, 0, 12, 2)} <= spans


def test_long_text_stays_whole(spark):
    words = [f"w{k}" for k in range(997)]
    text = " ".join(words * 60)
    docs = spark.createDataFrame([(1, text), (2, "b " * 100000)], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic.periodic_runs(docs, damage=False).collect()}
    assert (got[1].n_runs, got[1].start, got[1].length, got[1].period) == (1, 0, 997 * 60, 997)
    assert got[1].collapsed_sha256 == hashlib.sha256(" ".join(words).encode()).hexdigest()
    assert (got[2].length, got[2].period, got[2].exponent_milli) == (100000, 1, 100000000)
