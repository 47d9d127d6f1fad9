import numpy as np
import pytest

from namesmith.llm import ann, mtree

SF = "/root/testdata/sf0.01"


def rows_of(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: [x[1:] for x in sorted(v)] for q, v in got.items()}


def data(seed=4, n=900, d=12):
    r = np.random.default_rng(seed)
    x = (r.normal(size=(n, d)) * r.choice([0.2, 1, 3], size=(n, 1))).round(3)
    x[100:400] = x[100]  # copies of one vector
    return [(int(i), [float(v) for v in row]) for i, row in enumerate(x)]


ODD = [(2000, None), (2050, []), (2100, [None] + [1.0] * 11), (2150, [float("nan")] + [1.0] * 11), (2200, [float("inf")] * 12), (2250, [1.0] * 7), (None, [1.0] * 12), (2300, [0.0] * 12)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as score", "2 as q", "3 as cell", "4 as copy").repartition(3)


def exact(rows, floor, zero):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v and len(v) == 12 and None not in v and np.isfinite(v).all() and (zero or any(v))]
    ids, x = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    if floor:
        x = np.floor(256 * x).astype(np.int64)
        s = x @ x.T
    else:
        n = np.sqrt((x * x).sum(1))
        s = x @ x.T / n[:, None] / n
    out = {}
    for k, i in enumerate(ids):
        if i % 50 == 0:
            on = np.flatnonzero(ids != i)
            out[i] = [(ids[j], s[k, j]) for j in on[np.lexsort((ids[on], -s[k, on].round(9)))][:5]]
    return out


@pytest.mark.parametrize("block", [4096, 60])
def test_mtree_is_exact(spark, block):
    rows = data() + ODD
    got, want = rows_of(mtree.neighbours(frame(spark, rows), block=block)), exact(rows, True, True)
    assert got == {q: [(int(i), int(s)) for i, s in v] for q, v in want.items()}


def test_mtree_prunes():
    r = np.random.default_rng(1)
    centres = r.integers(-4000, 4000, (20, 8))
    x = (centres[r.integers(20, size=4000)] + r.integers(-30, 30, (4000, 8))).astype(np.int64)
    most = float((x**2).sum(1).max())
    tree = mtree.Tree(x, np.sqrt(most - (x.astype(float) ** 2).sum(1)))
    ids, own = np.arange(4000), np.zeros(4000, bool)
    spent = 0
    for q in x[:50]:
        found, computed = tree.search(q.astype(float), own, ids, 5, None, most)
        s = x @ q
        assert [f for f, _ in found] == s[np.lexsort((ids, -s))[:5]].tolist()
        spent += computed
    assert spent < 50 * 4000 / 2


@pytest.mark.parametrize("block", [4096, 50])
def test_forest(spark, block):
    rows = data() + ODD
    got, want = rows_of(ann.neighbours(frame(spark, rows), block=block, leaf=40)), exact(rows, False, False)
    assert set(got) == set(want)
    hits = 0
    for q, near in got.items():
        assert len(near) == 5 and [s for _, s in near] == sorted((s for _, s in near), reverse=True)
        hits += sum(s >= want[q][-1][1] - 1e-9 for _, s in near)
    assert hits >= 0.9 * 5 * len(want)


def test_forest_recall_on_isotropic_vectors(spark):
    d = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = rows_of(ann.neighbours(d))
    t = d.toPandas()
    x = np.stack(t["embedding"].map(lambda v: np.asarray(v, float)))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    hits = 0
    for q, near in got.items():
        s = x @ x[t["vec_id"] == q][0]
        s[t["vec_id"] == q] = -2
        hits += len({i for i, _ in near} & set(t["vec_id"].to_numpy()[np.argsort(-s)[:5]]))
    assert hits >= 0.9 * 5 * len(got)


def test_few_and_none(spark):
    few = [(0, [1.0, 0.0]), (1, [0.0, 2.0]), (50, [1.0, 1.0])]
    df = spark.createDataFrame(few, "vec_id long, embedding array<float>")
    for module in (ann, mtree):
        got = rows_of(module.neighbours(df))
        assert [i for i, _ in got[0]] == [50, 1] and [i for i, _ in got[50]] in ([0, 1], [1, 0])
        assert module.neighbours(df.limit(0)).count() == 0


def test_wide_components(spark):
    """Components whose products leave doubles, 64 bits or doubles' range of squares; brute force by Python's integers."""
    r = np.random.default_rng(8)
    rows = [(i, [float(v) for v in r.normal(size=3) * 2.0 ** r.integers(0, e)]) for i, e in enumerate([4] * 60 + [40] * 60 + [70] * 60 + [900] * 21)]
    rows += [(250, [2.0**20, 0.0, 0.0]), (251, [2.0**21, 1.0, 0.0])]
    for part in (rows[:60], rows[:120], rows[:180], rows):
        got = rows_of(mtree.neighbours(spark.createDataFrame(part, "vec_id long, embedding array<double>"), block=50))
        whole = {i: [int(np.floor(256 * x)) if abs(x) < 2**40 else int(x) * 256 for x in v] for i, v in part}
        for q in [i for i in whole if i % 50 == 0]:
            score = sorted(((sum(a * b for a, b in zip(whole[q], v)), -i) for i, v in whole.items() if i != q), reverse=True)[:5]
            assert got[q] == [(-i, min(max(s, -(1 << 63)), (1 << 63) - 1)) for s, i in score]


def test_several_dimensions(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(1, 100)] + [(200 + i, [1.0, 2.0, float(i)]) for i in range(4)] + [(300, [1.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for module in (ann, mtree):
        got = rows_of(module.neighbours(df))
        assert set(got) == {50, 200} and {i for i, _ in got[200]} == {201, 202, 203} and len(got[50]) == 5


def test_each_candidate_is_scored_once():
    r = np.random.default_rng(2)
    x = ann.unit(r.normal(size=(3000, 24)))
    trees = ann.forest(x, len(x))
    leaves = np.stack([t.leaf(x) for t in trees], 1)
    counts = [np.bincount(leaves[:, t], minlength=tree.leaves) for t, tree in enumerate(trees)]
    offsets = np.r_[0, np.cumsum([len(c) for c in counts])]
    wanted = np.zeros((20, offsets[-1]), bool)
    for i in range(20):
        for t, leaf in ann.search(x[i], trees, counts, ann.SHARE * len(x)):
            wanted[i, offsets[t] + leaf] = True
    scored = sum(ann.fresh(wanted, leaves + offsets[:-1], t).astype(int) for t in range(len(trees)))
    reached = sum(wanted[:, leaves[:, t] + offsets[t]].astype(int) for t in range(len(trees)))
    assert scored.max() == 1 and (scored == (reached > 0)).all() and scored.mean() < 0.9
