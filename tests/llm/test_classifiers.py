import zlib

import numpy as np
import pyarrow as pa
import pytest

from namesmith.llm import language, quality, toxicity

SF = "/root/testdata/sf0.01"
ODD = [(None, None, "de"), (900001, None, None), (900002, "", "en"), (900003, "12 + 34 %%", "en"), (900004, "the " * 30000, None), (900005, "the " * 20, "en"), (900005, "the " * 20, "en"), (900006, "١٢ €€", "x")]


def documents(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    return d.union(spark.createDataFrame(ODD, d.schema)).selectExpr("*", "1 as score", "2 as y", "3 as key", "true as held_out")


def held(doc_id, modulus, remainder):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == remainder


def checked(rows, n, modulus, remainder):
    assert len(rows) == n
    for r in rows:
        assert r.held_out == held(r.doc_id, modulus, remainder) and 0 <= r.score <= 1
        if hasattr(r, "predicted"):
            assert r.predicted == int(r.score >= 0.3)


def test_language(spark):
    d = documents(spark)
    model = language.fit(d)
    rows = language.predict(d, model).collect()
    checked(rows, d.count(), 5, 0)
    by = {r.doc_id: r for r in rows}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (None, 900001, 900002, 900003, 900006))
    assert by[900005].lang_pred == by[900004].lang_pred == "en"
    true = {r.doc_id: r.lang for r in d.collect()}
    own = [r for r in rows if r.held_out and r.doc_id < 900000]
    assert np.mean([r.lang_pred == true[r.doc_id] for r in own]) > 0.97
    runs = language.tag(d.limit(50), model).collect()
    assert runs and all(r.begin < r.end and 0 < r.probability <= 1.0001 for r in runs)


def test_code_switching(spark):
    model = language.fit(documents(spark))
    text = "the and of that with this from is to be was it are for on " * 3
    other = "der die und das ist nicht mit von sich den dem ein eine zu auf " * 3
    rows = language.tag(spark.createDataFrame([(1, text + other)], "doc_id long, text string"), model).collect()
    long = [r for r in rows if r.end - r.begin > 60]
    assert [r.lang for r in long] == ["en", "de"] and abs(long[0].end - len(text)) < 12


def brute_marginals(e, t):
    from itertools import product

    n, k = e.shape
    total, out = 0.0, np.zeros((n, k))
    for path in product(range(k), repeat=n):
        w = np.exp(sum(e[i, p] for i, p in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:])))
        total += w
        for i, p in enumerate(path):
            out[i, p] += w
    return out / total


def test_forward_backward():
    r = np.random.default_rng(2)
    e, t = r.normal(size=(9, 3)), r.normal(size=(3, 3))
    first, length = np.array([0, 4, 5]), np.array([4, 1, 4])
    got = language.forward_backward(e, t, first, length)
    for f, n in zip(first, length):
        assert np.allclose(got[f : f + n], brute_marginals(e[f : f + n], t), atol=1e-5)


def test_toxicity(spark):
    d, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    labels = labels.union(spark.createDataFrame([(None, 1, 1), (900002, None, None), (900001, 0, 0), (3, 5, 5)], labels.schema))
    model = toxicity.fit(d, labels)
    rows = toxicity.score(d, model).collect()
    checked(rows, d.count(), 4, 2)
    found = toxicity.offending_sentences(d, model).collect()
    texts = {r.doc_id: r.text for r in d.collect()}
    for r in found[:50]:
        assert texts[r.doc_id].encode()[r.begin : r.end].decode() == r.sentence


def test_toxicity_learns(spark):
    r = np.random.default_rng(1)
    words = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(800):
        bad = int(r.random() < 0.2)
        sentences = [" ".join(r.choice(words, 8)) for _ in range(6)]
        if bad:
            sentences[r.integers(6)] += " vile"
        rows.append((k, ". ".join(sentences) + "."))
        labels.append((k, 1, bad))
    d, l = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(d, l)
    true = dict((k, t) for k, _, t in labels)
    got = [x for x in toxicity.score(d, model).collect() if x.held_out]
    assert np.mean([x.predicted == true[x.doc_id] for x in got]) > 0.98
    assert all("vile" in x.sentence for x in toxicity.offending_sentences(d, model).collect())


def test_quality(spark):
    d, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.score(d, quality.fit(d, labels)).collect()
    checked(rows, d.count(), 5, 0)
    true = {r.doc_id: r.quality for r in labels.collect()}
    own = [r for r in rows if r.held_out and r.doc_id in true]
    good, bad = ([r.score for r in own if true[r.doc_id] == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.8


@pytest.mark.parametrize("module", [language, toxicity, quality])
def test_nothing_to_learn(spark, module):
    d = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    if module is language:
        assert {r.lang_pred for r in language.predict(one, language.fit(d)).collect()} == {"und"}
        assert language.predict(d, language.fit(d)).count() == 0
    else:
        assert len(module.score(one, module.fit(d, labels)).collect()) == 2
        assert module.score(d, module.fit(d, labels)).count() == 0


def repeated_key(spark, hot=2000):
    """The key of least hash that isn't held out by either fit, many times, and 500 others."""
    keys = [r.k for r in spark.range(4000).selectExpr("id k", "xxhash64(id) h").orderBy("h").collect() if not held(r.k, 5, 0) and not held(r.k, 4, 2)][:501]
    return [keys[0]] * hot, keys[1:]


def test_repeated_keys_count_once_in_labelled_sample(spark):
    from namesmith.llm.labelled import labelled_texts

    hot, others = repeated_key(spark)
    labels = spark.createDataFrame([(k, 1) for k in hot] + [(k, n % 2) for n, k in enumerate(others)], "doc_id long, quality int")
    docs = spark.createDataFrame([(k, f"text {k}") for k in hot + others] + [(hot[0], "another text")], "doc_id long, text string")
    rows = labelled_texts(docs, labels, "quality", 5, 0, 300).collect()
    assert len(rows) == 300 and {r.text for r in rows} == {"another text", *(f"text {k}" for k in others[:299])}


def test_repeated_keys_count_once_in_language_sample(spark, monkeypatch):
    hot, others = repeated_key(spark)
    docs = spark.createDataFrame([(k, "hot words", "en") for k in hot] + [(hot[0], "mots rares", "fr")] + [(k, f"word of {k} abc", "en") for k in others], "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(language, "train", lambda texts, languages: seen.append(list(zip(texts, languages))))
    language.fit(docs)
    (sample,) = seen
    assert len(sample) == 400 and sample.count((b"hot words", "en")) == 1 and all(y == "en" for _, y in sample)


@pytest.mark.parametrize("n", [2, 4])
def test_long_texts_are_one_chain(n):
    """Marginals of cut chains are those of uncut ones, also where transitions are strong."""
    r = np.random.default_rng(n)
    length = np.array([1500, 3, 1, 64, 65, 700, 128])
    emissions, transitions = r.normal(size=(int(length.sum()), n)), 3 * np.eye(n) + r.normal(size=(n, n))
    first = np.r_[0, np.cumsum(length)][:-1]
    uncut = language.forward_backward(emissions, transitions, first, length)
    for chain in (1, 7, 64, 1024):
        assert np.abs(language.chains(emissions, transitions, first, length, chain) - uncut).max() < 1e-4


def test_quality_against_brute_force(spark):
    """Scores again text by text: every block of every text with both dictionaries, then the logistic curve."""
    import math

    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    good, bad, slope, intercept = model = quality.fit(docs, labels)
    held = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), level=quality.LEVEL, write_content_size=False, write_dict_id=False) for d in (good, bad)]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame([(-1, None), (-2, ""), (-3, "word " * 40000)], "doc_id long, text string"))
    got = {r.doc_id: r for r in quality.score(rows, model).collect()}
    for r in rows.collect():
        data = (r.text or "").encode()
        a, b = (sum(len(c.compress(data[i : i + quality.BLOCK])) for i in range(0, len(data), quality.BLOCK)) for c in held)
        want = 1 / (1 + math.exp(-(slope * ((b - a) / (a + b) if data else 0.0) + intercept)))
        assert abs(got[r.doc_id].score - want) < 1e-9 and got[r.doc_id].predicted == (want >= 0.3)


def test_ties_between_languages(spark):
    """Without evidence for one of two languages the alphabetically first counts."""
    model = language.train([b"aaa bbb ccc", b"aaa bbb ccc"], ["xx", "aa"])
    got = language.predict(spark.createDataFrame([(1, "aaa bbb ccc")], "doc_id long, text string"), model).first()
    assert got.lang_pred == "aa"


def test_bags_of_long_texts_are_bounded():
    """Whole sentences from all over a long text; other documents as they are."""
    texts = ["short one. and two.", ". ".join(f"word{k} next{k} last" for k in range(5000)), "x" + " y" * 20000, "", "end."]
    ((features, sentence, document, rows, _),) = toxicity.bags(pa.array(texts))
    f, s, d = toxicity.bounded(features, sentence, document, 600)
    of = d[s]
    for k in range(rows):
        whole, kept = features[document[sentence] == k], f[of == k]
        assert len(kept) == len(whole) if len(whole) <= 600 else 500 < len(kept) <= 600
        if len(whole) <= 600:
            assert (kept == whole).all()
    assert (np.diff(s) >= 0).all() and (np.unique(s) == np.arange(len(d))).all()
    per = lambda f, s, k: {tuple(f[s == x]) for x in np.unique(s[k])}
    assert per(f, s, of == 1) <= per(*(x[document[sentence] == 1] for x in (features, sentence)), slice(None))
    again = toxicity.bounded(f, s, d, 600)
    assert all((a == b).all() for a, b in zip((f, s, d), again))


def test_what_a_fit_brings_to_the_driver(spark, monkeypatch):
    """Training rows of 100,000 words, and of words with much between them, cost the driver what bounded ones do."""
    long = " ".join(f"word{k % 977}" + ("." if k % 9 == 0 else "") for k in range(100000))
    gaps = ("0123456789 " * 3000).join(["alpha", "beta", "gamma", "delta"] * 8) + " " + "z" * 500000
    rows = [(k, (long, gaps, "a short text.")[k % 3], "en") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(60)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(language, "train", lambda texts, languages: seen.extend(texts))
    monkeypatch.setattr(toxicity, "train", lambda parts: seen.extend(p for p in parts))
    language.fit(docs)
    assert seen and max(map(len, seen)) <= (language.WORDS + 20) * (language.WORD_BYTES + 1)
    assert any(t.split()[:4] == [b"alpha", b"beta", b"gamma", b"delta"] for t in seen)
    seen.clear()
    toxicity.fit(docs, labels)
    for f, s, d, y in seen:
        assert (np.bincount(d[s], minlength=len(y)) <= toxicity.FIT_FEATURES).all()
    assert sum(len(y) for *_, y in seen) == sum(not held(k, 4, 2) for k in range(60))
