"""The similarity join against all pairs."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from namesmith.functions.similarity import ratio, ratios
from namesmith.operators import likeness, lexicon, sectors
from namesmith.operators.knowledge import Knowledge
from namesmith.storage import ship


def changed(rng, word):
    for _ in range(rng.randint(0, 3)):
        k = rng.randrange(len(word) + 1)
        word = word[:k] + rng.choice(["", "E", "AR"]) + word[k + rng.randint(0, 1) :]
    return word


def sample(rng, size, parts=("AR", "EN", "TO", "RI", "LA", "CO", "MES", "DOR", "ERIA", "S", "Ñ", "A")):
    return sorted({"".join(rng.choice(parts) for _ in range(rng.randint(0, 6))) for _ in range(size)})


@pytest.mark.parametrize("threshold", [82.0, 88.0, 90.0, 95.0])
def test_no_pair_is_lost(spark, threshold):
    rng = random.Random(int(threshold))
    words = sample(rng, 250)
    texts = sorted({changed(rng, rng.choice(words)) for _ in range(400)} | {"", "A", "Ñ", "AAAAAAAAAA", "AAAAAAAAA", "X" * 90, "X" * 99})
    words += ["AAAAAAAAAAA", "X" * 95, "X" * 80 + "YY"]
    frame = spark.createDataFrame([(t,) for t in texts * 2] + [(None,)], "text string")
    got = likeness.similar(frame, likeness.vocabulary(ship(spark), words), threshold).collect()
    want = {(t, w) for t in texts for w in words if ratio(t, w) >= threshold}
    assert {(r.text, r.word) for r in got} == want and len(got) == len(want) > 80
    assert all(r.ratio == ratio(r.text, r.word) for r in got)


def test_far_fewer_pairs(spark):
    rng = random.Random(1)
    letters = "ABCDEFGILMNOPRSTUV"
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(7, 13))) for _ in range(5000)})
    texts = sorted({changed(rng, rng.choice(words)) for _ in range(2000)})
    frame, vocabulary = spark.createDataFrame(pd.DataFrame({"text": texts})), likeness.vocabulary(ship(spark), words)
    verified = likeness.candidates(frame, vocabulary, 90.0).count()
    able = sum(200 * min(len(t), len(w)) >= 90 * (len(t) + len(w)) for t in texts for w in words)
    assert 20 * verified < able
    got = {r.text: r.word for r in likeness.best(frame, vocabulary, 90.0, lambda t, w: ~F.contains(t, w)).collect()}
    want = {}
    for t in rng.sample(texts, 150):
        near = ratios([t] * len(words), words)
        best = max((k for k in range(len(words)) if words[k] not in t), key=lambda k: (near[k], -k))
        if near[best] >= 90:
            want[t] = words[best]
    assert want and all(got.get(t) == w for t, w in want.items())


def test_corrections_of_a_large_catalogue(spark):
    """5,000 catalogue words: corrections and near words of records as by looking at all pairs."""
    rng = random.Random(2)
    keys = sorted({"".join(rng.choice("ABCDEILMNOPRST") for _ in range(rng.randint(8, 12))) for _ in range(5000)})
    knowledge = Knowledge(catalogue=[(k, "A", "01", 7) for k in keys])
    names = [(k, "x", [changed(rng, rng.choice(keys)) if rng.random() < 0.5 else "CASA" for _ in range(3)]) for k in range(60)]
    rows = spark.createDataFrame([*names, names[0]], "idx long, nombre_original string, palabras array<string>")
    targets, known = sorted(knowledge.typo_targets), set(knowledge.known)

    def fix(t):
        if len(t) < 8 or t in known:
            return t
        able = [w for w in targets if abs(len(t) - len(w)) <= 2 and not (t.startswith(w) or w.startswith(t) or t.endswith(w) or w.endswith(t)) and ratio(t, w) >= 90]
        return min(able, key=lambda w: (-ratio(t, w), w)) if able else t

    got = lexicon.typo_correction(rows, knowledge).collect()
    assert len(got) == 61 and all(r.palabras == [fix(t) for t in names[r.idx][2]] for r in got)
    assert any(r.palabras != names[r.idx][2] for r in got)
    lists = spark.createDataFrame([(k, w) for k, _, w in names] + [(98, []), (99, ["CASA"])], "idx long, tokens array<string>")
    near = {r.idx: r.aprox for r in sectors.approximate(lists, knowledge).collect()}
    assert len(near) == 62 and near[98] == near[99] == "" and sum(v != "" for v in near.values()) > 5
