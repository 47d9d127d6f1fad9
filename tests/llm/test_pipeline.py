import corpus_pipeline as cp
from namesmith.llm import language, toxicity
from namesmith.llm.ngram_join import jaccard_components
from namesmith.llm.runtime import table

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    clean = cp.toxicity_stage(spark, docs, SF)
    want = {r.doc_id for r in toxicity.score(docs, model).collect() if not r.predicted}
    assert clean.schema == docs.schema and {r.doc_id for r in clean.collect()} == want and 0 < len(want) <= docs.count()
    kept = cp.language_stage(spark, clean, SF)
    scores = language.predict(clean, language.fit(clean)).collect()
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scores if r.lang_pred != "und" and r.score >= 0.5}
    one = cp.near_duplicate_stage(spark, kept, SF)
    groups = {r.component_id for r in jaccard_components(kept.select("doc_id", "text")).collect()}
    ids = [r.doc_id for r in one.collect()]
    assert set(one.columns) == set(docs.columns) and sorted(ids) == sorted(groups)
    assert {r.doc_id for r in cp.packing_stage(spark, one, SF).collect()} == set(ids)


def test_run(spark):
    out = cp.run(spark, SF)
    assert out.count() > 0 and "sequence_id" in out.columns


def test_odd_rows(spark):
    rows = [(1, "one two three four five six", "en", "s", 1)] * 2 + [(2, None, None, None, None), (None, "one two three four five six", "en", None, 1), (None, "quite other words in this one row", "en", None, 1), (3, "ONE two three four five six", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(map(str, (r.doc_id for r in cp.near_duplicate_stage(spark, docs, SF).collect()))) == ["1", "2", "None"]
    for name, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name


def test_texts_in_no_learned_language(spark):
    docs = table(spark, SF, "documents")
    finnish = "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto ja heidän on toimittava toisiaan kohtaan veljeyden hengessä"
    polish = "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa"
    junk = "xqzj kwvx qqpzt zzkx vvbnq xkcd jjwq pzqx wqjk zxcvb qwrtp hjklz mnbvq xzqk"
    own = docs.where("lang = 'de' and length(text) > 400").first().text
    odd = [(-1, finnish), (-2, polish), (-3, junk), (-4, own + " " + finnish)]
    both = docs.unionByName(spark.createDataFrame([(d, t, None, None, None) for d, t in odd], docs.schema))
    kept = {r.doc_id for r in cp.language_stage(spark, both, SF).collect()}
    assert kept & {-1, -2, -3, -4} == {-4}
    assert len(kept) > 0.99 * docs.where("text is not null").count()
    # With two learned languages one always has half of the marginal mass.
    two = docs.where("lang in ('de', 'en')").unionByName(both.where("doc_id < 0"))
    assert {r.doc_id for r in cp.language_stage(spark, two, SF).collect()} & {-1, -2, -3, -4} == {-4}


def test_near_copies_of_one_doc_id(spark):
    words = [f"w{k}" for k in range(60)]
    text, near, other = " ".join(words), " ".join([*words[:-1], "end"]), " ".join(f"x{k}" for k in range(60))
    rows = [(1, text), (1, near), (1, near), (1, other), (0, other), (5, near), (7, None), (7, None), (7, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = cp.near_duplicate_stage(spark, docs, SF)
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert out.columns == docs.columns and len(got) == 4
    assert sum(t in (text, near) and d == 1 for d, t in got) == 1
    assert {(0, other), (7, None), (7, "")} < set(got)


def test_clashing_columns_long_texts_and_ties(spark):
    words = [f"w{k}" for k in range(40)]
    rows = [(3, " ".join(words)), (2, " ".join([*words[:-1], "end"])), (2, " ".join([*words[:-1], "end"])), (9, "long " * 300000), (8, "long " * 300000), (1, "another text of its own here")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    names = ["kept", "key", "row", "check", "group", "KEY_", "row_key", "row_id", "component_id", "n_shingles", "class", "held_out", "score", "piece", "offset"]
    docs = docs.selectExpr("*", *(f"{k} as {name}" for k, name in enumerate(names)))
    out = cp.near_duplicate_stage(spark, docs, SF)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 2, 8]
    assert all(r[name] == k for r in out.collect() for k, name in enumerate(names))
    for stage in (cp.toxicity_stage, cp.language_stage):
        assert stage(spark, docs, SF).columns == docs.columns
    assert cp.packing_stage(spark, docs, SF).count() == 5 + 2 * -(-300001 // 2048) - 1


def test_stages_against_brute_force(spark):
    """The stages again in plain Python: models applied text by text, all pairs of shingle sets, bins by their own capacities."""
    import math
    import re

    import numpy as np
    import pyarrow as pa

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    weights, bias = toxicity.fit(docs, table(spark, "/root/testdata/sf0.001", "labels"))

    def feature(word: bytes) -> int:
        return int(toxicity.span_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0]) >> (64 - toxicity.BITS)

    def toxic(text) -> float:
        clean = 1.0
        for sentence in re.split(rb"[\n!.?]", toxicity.lowered(np.frombuffer((text or "").encode(), np.uint8)).tobytes()):
            words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", sentence)
            if words:
                z = bias + sum(float(weights[feature(f)]) for w in words for f in [w, *(w[:h] for h in toxicity.HEADS if len(w) > h)])
                clean *= 1 - 1 / (1 + math.exp(-z))
        return 1 - clean

    scores = {r.doc_id: r.score for r in toxicity.score(docs, (weights, bias)).collect()}
    assert all(abs(scores[d] - toxic(t)) < 1e-6 for d, t in rows)
    left = {d for d, t in rows if toxic(t) < 0.3}
    clean = cp.toxicity_stage(spark, docs, "/root/testdata/sf0.001")
    assert {r.doc_id for r in clean.collect()} == left
    model = language.fit(clean)
    texts = dict(rows)
    fits = {d for d in left if (lambda p: p[0][0] < len(model["names"]) and p[1][0] >= 0.5)(language.languages_of(pa.array([texts[d]]), model))}
    kept = cp.language_stage(spark, clean, "/root/testdata/sf0.001")
    assert {r.doc_id for r in kept.collect()} == fits
    sets = {}
    for d in fits:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in texts[d]))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    name = {d: d for d in fits}

    def root(d):
        while name[d] != d:
            d = name[d]
        return d

    for a in fits:
        for b in fits:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                name[y] = x
    one = cp.near_duplicate_stage(spark, kept, "/root/testdata/sf0.001")
    assert sorted(r.doc_id for r in one.collect()) == sorted({root(d) for d in fits})
