import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from namesmith.llm import byte_bpe, packing

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n  a", "x" * 3000, "ab" * 2000, "é ü̈ ß ΣΑΣ ὈΔΥΣΣΕΎΣ", "a\x1cb\x85c d​e f᠎g", "don't WE'LL 123 1234567 ...!?", "日本語テキスト 한국어", "👩‍👩‍👧 ok", "tab\tand  spaces   ", "zz" * 300 + " " + "1" * 700, "ab<|endoftext|>cd <|startoftext|> x", "İstanbul ﬁ Å"]


def texts():
    r = random.Random(5)
    return ODD + ["".join(r.choice("abcde fghij'.\n0123ÀÉß漢") for _ in range(r.randint(1, 700))) for _ in range(60)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_bpe_is_tiktoken(name):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(name), "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = byte_bpe.Encoder(P.path(name), P.PATTERN)
    every = [t or "" for t in texts()]
    for text, ids in zip(every, encoder.texts(every)):
        assert ids.tolist() == own.encode_ordinary(text), text[:60]
        assert encoder.decode(ids) == text.encode()


def test_long_pieces():
    r = random.Random(3)
    pieces = ["".join(r.choice(a) for _ in range(n)) for a in ("ab", "abc", "etaoinshr", "abcdefghijklmnopqrstuvwxyz", "-=_#") for n in (385, 1000, 6000)] + ["a" * 2001, "=" * 900, "é漢" * 700]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})
    encoder = byte_bpe.Encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    for piece in pieces:
        assert encoder._long(piece.encode()).tolist() == own.encode_ordinary(piece), piece[:20]


@pytest.mark.parametrize("seed", range(6))
def test_long_pieces_where_merges_bring_lesser_ranks(seed, tmp_path):
    r = random.Random(seed)
    tokens = {bytes([b]) for b in range(256)}
    for _ in range(400):  # unions of two earlier tokens, ranked at random
        a, b = (r.choice([t for t in tokens if t[0] in b"abc"]) for _ in range(2))
        if len(a + b) < 12:
            tokens.add(a + b)
    single, joined = sorted(t for t in tokens if len(t) == 1), [t for t in tokens if len(t) > 1]
    r.shuffle(joined)
    path = tmp_path / "ranks"
    path.write_text("\n".join(f"{base64.b64encode(t).decode()} {k}" for k, t in enumerate(single + joined)))
    own = tiktoken.Encoding("own", pat_str="(?s).+", mergeable_ranks={t: k for k, t in enumerate(single + joined)}, special_tokens={})
    encoder = byte_bpe.Encoder(str(path), P.PATTERN)
    for n in (5, 60, 500, 3000):
        piece = "".join(r.choice("abc") for _ in range(n))
        assert encoder._long(piece.encode()).tolist() == own.encode_ordinary(piece)


def test_bpe_query(spark):
    rows = [(k, t) for k, t in enumerate(texts())] + [(None, "null id"), (3, "again"), (3, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as ids", "'' as bytes")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for d, t in rows:
        ids = own.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = byte_bpe.digests(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert byte_bpe.digests(df.limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


@pytest.mark.parametrize("ordinary", [False, True])
def test_packing(spark, ordinary):
    path = P.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = ordinary
    rows = [(k, x) for k, x in enumerate(texts())] + [(1000, "word " * 5000), (None, "null id"), (3, "again"), (1001, "a " * 2047), (1002, "a " * 2048)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as piece", "1 as offset").coalesce(1)
    got = packing.pack(df, path, ordinary=ordinary).collect()
    want = []
    for d, x in rows:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 0]
        for k, i in enumerate(range(0, len(ids), 2048)):
            own = ids[i : i + 2048]
            want.append((d, k, i, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-sum(w[3] for w in want) // 2048) + 2
    assert packing.pack(df.limit(0), path).count() == 0


def test_units_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(packing, "span_hashes", lambda raw, starts, ends: np.zeros(len(starts), np.uint64))
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    words = ["one", "two", "three", "one", "internationalisation-a", "internationalisatiox-a", "123", "characteristically", "characteristicalmy"]
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    ids, _ = packing.WordIds(P.path("word_bpe_49k.json"))(raw, np.array([0, len(raw)]))
    assert ids.tolist() == [*t.encode(" ".join(words), add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("parts", [1, 16, 211])
def test_sequences_do_not_depend_on_partitions(spark, parts):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(parts)
    got = packing.pack(docs, P.path("word_bpe_49k.json")).selectExpr("sum(length)", "count(distinct sequence_id)").first()
    assert got[1] <= 1.01 * -(-got[0] // 2048) + 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    r = np.random.default_rng(1)
    length = np.sort(r.integers(1, 2048, 3000))[::-1].astype(float)
    demand = np.stack([length, np.ones(3000), length**2], 1)
    capacity = np.array([2048, 5, 2048.0**2])
    bins = packing.best_fit(demand, capacity, np.array(packing.WEIGHTS), rule)
    for c in range(3):
        assert np.bincount(bins, demand[:, c]).max() <= capacity[c] + 1e-6
    if rule == "norm":
        assert bins.max() + 1 <= max(length.sum() / 2048, 3000 / 5) * 1.05


def test_words_as_whole_texts():
    import pyarrow.parquet as pq

    some = pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()[:80]
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    words = packing.WordIds(P.path("word_bpe_49k.json"))
    import pyarrow as pa

    from namesmith.llm.shingles import utf8_buffers

    ids, bounds = words(*utf8_buffers(pa.array(some)))
    for text, i, j in zip(some, bounds[:-1], bounds[1:]):
        assert ids[i:j].tolist() == [*t.encode(text or "", add_special_tokens=False).ids, 0]


def test_units_fuzzed():
    import pyarrow as pa

    from namesmith.llm.shingles import utf8_buffers

    r = random.Random(9)
    alphabet = ["a", "B", "é", "É", "×", "÷", "'", "'s", "'t", "=", "̸", "́", ",", "—", "…", "1", "٣", " ", "\n", " ", "ß", "漢", "ñ", "#", "ﬁ", "İ", "Σ", "º"]
    some = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    words = packing.WordIds(P.path("word_bpe_49k.json"))
    for part in (some[:1500], some[1500:]):
        ids, bounds = words(*utf8_buffers(pa.array(part)))
        for text, i, j in zip(part, bounds[:-1], bounds[1:]):
            assert ids[i:j].tolist() == [*t.encode(text, add_special_tokens=False).ids, 0], ascii(text)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_is_best_fit(rule):
    r = np.random.default_rng(2)
    for n, most in ((4000, 2048), (3000, 5)):
        length = np.sort(r.integers(1, 2049, n) if most == 5 else r.choice([3, 40, 41, 700, 900, 1100, 2048], n))[::-1]
        lengths, counts = np.unique(length, return_counts=True)
        places = packing.plan(lengths[::-1].tolist(), counts[::-1].tolist(), most_documents=most, rule=rule)
        bins = defaultdict(list)
        for x, c in zip(lengths.tolist(), counts.tolist()):
            own = places[places[:, 0] == x]
            for k in range(c):
                _, first, sequence, each, offset = own[np.searchsorted(own[:, 1], k, "right") - 1].tolist()
                bins[sequence + (k - first) // each].append((offset + (k - first) % each * x, x))
        for own in bins.values():
            own.sort()
            assert len(own) <= most and [o for o, _ in own] == np.cumsum([0, *(x for _, x in own[:-1])]).tolist() and own[-1][0] + own[-1][1] <= 2048
        demand = np.stack([length, np.ones(n), length**2.0], 1).astype(float)
        one = int(packing.best_fit(demand, np.array([2048, most, 2048.0**2]), np.array(packing.WEIGHTS), rule).max()) + 1
        assert sorted(bins) == list(range(len(bins))) and abs(len(bins) - one) <= 1 + one // 200
    assert packing.plan([], []).shape == (0, 5)


def test_sequences_over_all_tasks(spark):
    path = P.path("word_bpe_49k.json")
    hot = [(k, "a " * 1099) for k in range(60)] + [(100 + k, "a " * 899) for k in range(60)] + [(200 + k, "a " * 47) for k in range(60)]
    # Length-ordered rows, a task for each length; then as many tasks as rows.
    for tasks in (3, 180):
        df = spark.createDataFrame(spark.sparkContext.parallelize(hot, tasks), "doc_id long, text string")
        got = packing.pack(df, path).collect()
        tokens = sum(r.length for r in got)
        assert len(got) == 180 and {r.length for r in got} == {1100, 900, 48}
        assert len({r.sequence_id for r in got}) == -(-tokens // 2048) == 60
        for s in {r.sequence_id for r in got}:
            assert sorted(r.offset for r in got if r.sequence_id == s) == [0, 1100, 2000]
