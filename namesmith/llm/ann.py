"""Approximate nearest neighbours: a forest of random-projection trees with a shared priority queue.

Trees are fitted on at most ``SAMPLE`` vectors: a node's hyperplane lies between two random points of the node, at the
median projection. Every row is indexed: it falls into one leaf of each tree. A query pops nodes of all trees from one
priority queue, best margin first, until the leaves it has reached hold ``SHARE`` times as many rows as there are (rows
count once for each tree). Candidates are the rows of these leaves; a row that several of them hold is scored once, by
exact cosine in double precision. Vectors without near neighbours need a wide search, hence the large share: recall on
isotropic vectors is the measured worst case.

Neighbouring leaves of up to ``BLOCK`` rows together form a task's group; a leaf of more rows (copies of one vector fall
together) is cut into pieces of about that size, each with all of the leaf's queries, and counts only as a leaf of
usual size when the queue's budget is spent. Only trees and leaf counts, both bounded by the sample and ``DEPTH``, are
at the driver or sent to all tasks.

Vectors that are null, zero or hold null or non-finite components and rows without an id take no part. Vectors of
different dimensions aren't compared: each dimension has a forest, and a query without another row of its dimension
has no result. Ties go to the smaller vec_id. Repeated ids: each row is a candidate and a query of its own; a query's
own row means all rows of its id. Long vectors are rows like others. An empty table gives an empty result; other columns
of the input are ignored, whatever their names.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import durable, ship
from .shingles import mix
from .vectors import by_dimension, matrix, sample, top, usable

SAMPLE, TREES, DEPTH, LEAF, SHARE, BLOCK = 8192, 4, 10, 96, 1.1, 4096


class Tree:
    """Hyperplanes of a binary tree; ``children`` >= 0 are nodes, others leaves ~child."""

    def __init__(self, points: np.ndarray, depth: int, rng: np.random.Generator):
        self.normals, self.offsets, self.children = [], [], []
        self.leaves = 0
        self.root = self._grow(points, depth, rng)
        d = points.shape[1]
        self.normals, self.offsets, self.children = np.array(self.normals).reshape(-1, d), np.array(self.offsets), np.array(self.children, np.int64).reshape(-1, 2)

    def _grow(self, points, depth, rng) -> int:
        if depth and len(points) >= 8:
            a, b = points[rng.choice(len(points), 2, replace=False)]
            normal = a - b
            length = np.sqrt(normal @ normal)
            if length > 0:
                normal /= length
                at = points @ normal
                offset = float(np.median(at))
                right = at > offset
                if 0 < right.sum() < len(points):
                    node = len(self.normals)
                    self.normals.append(normal)
                    self.offsets.append(offset)
                    self.children.append([0, 0])
                    self.children[node] = [self._grow(points[~right], depth - 1, rng), self._grow(points[right], depth - 1, rng)]
                    return node
        self.leaves += 1
        return ~(self.leaves - 1)

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row."""
        node = np.full(len(x), self.root)
        live = np.flatnonzero(node >= 0)
        while len(live):
            n = node[live]
            right = np.einsum("ij,ij->i", x[live], self.normals[n]) > self.offsets[n]
            node[live] = self.children[n, right.astype(int)]
            live = live[node[live] >= 0]
        return ~node


def unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def level(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest component near 1: cosines stay the same, squares finite."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def forest(points: np.ndarray, total: int, trees: int = TREES, depth: int = DEPTH, leaf: int = LEAF, seed: int = 11) -> list[Tree]:
    points = np.unique(unit(points), axis=0) if len(points) else points
    depth = int(min(depth, max(0, np.floor(np.log2(max(total, 1) / leaf)))))
    rng = np.random.default_rng(seed)
    return [Tree(points, depth, rng) for _ in range(trees)] if len(points) else []


def search(q: np.ndarray, trees: list[Tree], counts: list[np.ndarray], budget: float) -> list[tuple[int, int]]:
    """(tree, leaf) pairs in the order of the shared queue until their rows reach ``budget``."""
    margins = [t.normals @ q - t.offsets for t in trees]
    queue = [(-np.inf, k, t.root) for k, t in enumerate(trees)]
    heapq.heapify(queue)
    out, held = [], 0.0
    while queue and held < budget:
        bound, k, node = heapq.heappop(queue)
        if node < 0:
            if counts[k][~node]:
                out.append((k, ~node))
                held += counts[k][~node]
            continue
        m, (left, right) = float(margins[k][node]), trees[k].children[node].tolist()
        heapq.heappush(queue, (max(bound, m), k, left))
        heapq.heappush(queue, (max(bound, -m), k, right))
    return out


def _indexer(trees: list[Tree], dims: int):
    def run(batches):
        for batch in batches:
            x = unit(matrix(batch.column("embedding")))
            leaves = np.stack([t.leaf(x) for t in trees], 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.array(list(leaves), pa.list_(pa.int32()))], names=["vec_id", "embedding", "leaves"])

    return run


def buckets_of(counts: list[np.ndarray], block: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each tree (bucket of each leaf, pieces of each bucket): neighbouring leaves of up to ``block`` rows together."""
    out, made = [], 0
    for c in counts:
        bucket, pieces, held = np.zeros(len(c), np.int32), {}, block
        for leaf, n in enumerate(c.tolist()):
            if held + n > block:
                made, held = made + 1, 0
            bucket[leaf], held = made, held + n
            pieces[made] = max(1, -(-held // block))
        out.append((bucket, np.array([pieces[b] for b in bucket.tolist()], np.int32)))
    return out


def _placer(places):
    schema = pa.schema([("bucket", pa.int32()), ("piece", pa.int32()), ("leaves", pa.list_(pa.int32())), ("vec_id", pa.int64()), ("copy", pa.int64()), ("embedding", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            leaves = np.stack(batch.column("leaves").to_numpy(zero_copy_only=False))
            copy = batch.column("copy").to_numpy()
            for t, (bucket, pieces) in enumerate(places):
                piece = (mix(copy.view(np.uint64)) % pieces[leaves[:, t]].astype(np.uint64)).astype(np.int32)
                columns = (pa.array(bucket[leaves[:, t]]), pa.array(piece), batch.column("leaves"), batch.column("vec_id"), batch.column("copy"), batch.column("embedding"))
                yield pa.RecordBatch.from_arrays(list(columns), schema=schema)

    return run, "bucket int, piece int, leaves array<int>, vec_id long, copy long, embedding array<double>"


def _searcher(trees: list[Tree], counts: list[np.ndarray], places, total: int, share: float):
    usual = [np.minimum(c, 4 * max(1, total // max(1, len(c)))) for c in counts]
    budget = share * sum(c.sum() for c in usual) / len(usual) if usual else 0
    offsets = np.r_[0, np.cumsum([len(c) for c in counts])]
    schema = pa.schema([("bucket", pa.int32()), ("piece", pa.int32()), ("query_id", pa.int64()), ("q", pa.int64()), ("embedding", pa.list_(pa.float64())), ("wanted", pa.binary())])

    def run(batches):
        for batch in batches:
            vectors = batch.column("embedding")
            x = unit(matrix(vectors))
            rows, of, wanted = [], [], []
            for i, v in enumerate(x):
                bits, cut = np.zeros(offsets[-1], bool), {}
                for t, leaf in search(v, trees, usual, budget):
                    bits[offsets[t] + leaf] = True
                    cut[int(places[t][0][leaf])] = int(places[t][1][leaf])
                wanted.append(np.packbits(bits).tobytes())
                for b, pieces in cut.items():
                    rows += [(b, piece) for piece in range(pieces)]
                    of += [i] * pieces
            at = pa.array(of, pa.int64())
            columns = [pa.array([r[k] for r in rows], schema.types[k]) for k in (0, 1)] + [batch.column("query_id").take(at), batch.column("q").take(at), vectors.take(at), pa.array(wanted, pa.binary()).take(at)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run, "bucket int, piece int, query_id long, q long, embedding array<double>, wanted binary"


def fresh(wanted: np.ndarray, leaves: np.ndarray, tree: int) -> np.ndarray:
    """Whether each query (rows of ``wanted``: leaves of all trees) scores each row in this tree: no earlier one brings it.

    ``leaves``: each row's leaf in each tree, counted over all trees.
    """
    out = wanted[:, leaves[:, tree]]
    for earlier in range(tree):
        out &= ~wanted[:, leaves[:, earlier]]
    return out


def _rerank(k: int, counts: list[np.ndarray], places):
    offsets = np.r_[0, np.cumsum([len(c) for c in counts])]
    tree_of = {b: t for t, (bucket, _) in enumerate(places) for b in bucket.tolist()}
    schema = pa.schema([("query_id", pa.int64()), ("q", pa.int64()), ("vec_id", pa.int64()), ("copy", pa.int64()), ("score", pa.float64())])

    def run(key, rows, queries):
        out = []
        if len(rows) and len(queries):
            tree = tree_of[key[0].as_py()]
            ids, copy, x = rows["vec_id"].to_numpy(), rows["copy"].to_numpy(), matrix(rows["embedding"])
            x = level(x)
            norms = np.sqrt((x * x).sum(1))
            leaves = matrix(rows["leaves"]).astype(np.int64) + offsets[:-1]
            names, numbers, y = queries["query_id"].to_numpy(), queries["q"].to_numpy(), matrix(queries["embedding"])
            y = level(y)
            wanted = np.stack([np.unpackbits(np.frombuffer(w, np.uint8), count=offsets[-1]) for w in queries["wanted"].to_pylist()]).astype(bool)
            for at in range(0, len(y), 256):
                able = fresh(wanted[at : at + 256], leaves, tree) & (names[at : at + 256, None] != ids[None, :])
                for i, mask in enumerate(able, at):
                    own, v = np.flatnonzero(mask), y[i]
                    if len(own):
                        score = np.clip(x[own] @ v / (norms[own] * np.sqrt(v @ v)), -1, 1)
                        near = np.flatnonzero(score >= np.partition(score, max(0, len(own) - k))[max(0, len(own) - k)] - 1e-12)
                        own = own[near]
                        # Sums in one order for all, so that equal vectors have equal scores.
                        exact = np.clip((x[own] * v).sum(1) / (norms[own] * np.sqrt((v * v).sum())), -1, 1)
                        for j in np.lexsort((copy[own], ids[own], -exact))[:k]:
                            out.append((names[i], numbers[i], ids[own[j]], copy[own[j]], exact[j]))
        return pa.Table.from_arrays([pa.array([o[c] for o in out], f.type) for c, f in enumerate(schema)], schema=schema)

    return run


_RESULT = "query_id long, rank int, vec_id long, score double"


def neighbours(embeddings: DataFrame, every: int = 50, k: int = 5, share: float = SHARE, block: int = BLOCK, **shape) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest by cosine found for every row whose id is divisible by ``every``.

    ``shape``: trees, depth, leaf (rows a leaf, where depth allows) and seed of the forest.
    """
    ship(embeddings.sparkSession)
    rows = usable(embeddings, "vec_id", "embedding", True).where("vec_id is not null")
    return by_dimension(rows, lambda own, _: _neighbours(own, every, k, share, block, shape), _RESULT)


def _neighbours(rows: DataFrame, every: int, k: int, share: float, block: int, shape: dict) -> DataFrame:
    _, points = sample(rows, SAMPLE)
    total = rows.count()
    trees = forest(points, total, **shape)
    indexed = durable(rows.mapInArrow(_indexer(trees, points.shape[1]), "vec_id long, embedding array<double>, leaves array<int>").withColumn("copy", F.monotonically_increasing_id()), "index")
    counts = [np.zeros(t.leaves, np.int64) for t in trees]
    for t, leaf, n in indexed.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count().collect():  # at most TREES * 2^DEPTH rows
        counts[t][leaf] = n
    places = buckets_of(counts, block)
    placed = indexed.mapInArrow(*_placer(places))
    queries = indexed.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("copy").alias("q"), "embedding")
    asked = queries.mapInArrow(*_searcher(trees, counts, places, total, share))
    scores = placed.groupBy("bucket", "piece").cogroup(asked.groupBy("bucket", "piece")).applyInArrow(_rerank(k, counts, places), "query_id long, q long, vec_id long, copy long, score double")
    return top(scores, k)
