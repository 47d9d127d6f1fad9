import random
import re

import pytest

from namesmith.llm.ngram_join import jaccard_components


def brute(rows):
    sets = []
    for _, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        sets.append(frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def made(seed, groups=6, copies=14):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 4)))
    common = [word() for _ in range(30)]
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(r.randint(20, 120))] + common * r.randint(0, 1)
        for _ in range(copies):
            text = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 12))):
                text[r.randrange(len(text))] = word()
            rows.append((len(rows) * 7 % 1009, r.choice([" ", "\n", "\t "]).join(text).replace("a", r.choice("aA"))))
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "one Two"), (2004, "ONE two"), (2005, "one two three"), (2003, "one Two"), (None, "one two"), (2006, "x" * 50000), (2007, "w " * 30000)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,block,flush,share", [(1, 1024, 1_000_000, 1_000_000), (2, 3, 300, 200), (3, 2, 50, 7)])
def test_against_brute_force(spark, seed, block, flush, share):
    rows = made(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "1 as n", "2 as class", "3 as token", "4 as pivot", "5 as bucket", "6 as flush")
    got = jaccard_components(df, block=block, flush=flush, share=share)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_empty(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_long_path(spark):
    from namesmith.llm.runtime import components

    edges = spark.createDataFrame([(k, k + 1) for k in range(150)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert len(got) == 153 and len({got[k] for k in range(151)}) == 1 and got[500] == got[501] != got[0]
    assert components(edges.where("a = b")).count() == 0
