"""Exact top-k by integer inner product with M-trees.

Components become floor(scale * x). With M the largest norm, a vector v gains the component sqrt(M^2 - |v|^2) and a
query q a zero; then |q' - v'|^2 = |q|^2 + M^2 - 2 q.v, so largest inner product is least distance, and distance is a
metric. Rows are dealt to cells by their nearest of at most ``CELLS`` sampled pivots and cells are cut into blocks of
about ``BLOCK`` rows. Each block is bulk-loaded into an M-tree: pages of ``PAGE`` entries, routing objects with covering
radii, and each entry's distance to its parent. A query starts with the k-th best score within a bounded sample as its
bound, leaves out cells beyond it by covering radius, and searches each block best-first; stored parent distances and the
triangle inequality leave out entries before any distance is computed. Bounds get a slack against rounding, and scores
are exact integers, so the result is exact.

Scores come from double arithmetic where that is exact, else from 64-bit, else from unbounded integers; one that 64
bits can't hold is ranked by its true value and given as the nearest value that they can. Null vectors, vectors with
null or non-finite components (also if only ``scale`` times a component isn't finite) and rows without an id take no
part. Vectors of different dimensions aren't compared: a query without another row of its dimension has no result.
Ties go to the smaller vec_id. Repeated ids: each row is a candidate and a query of its own; a query's own row means
all rows of its id. Long vectors are rows like others. An empty table gives an empty result; other columns of the input
are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import durable, ship
from .vectors import by_dimension, matrix, sample, top, usable

SAMPLE, CELLS, BLOCK, PAGE, FANOUT = 2048, 64, 4096, 128, 8
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def arithmetic(a: np.ndarray, b: np.ndarray):
    """The narrowest type in which inner products of rows (whole numbers as doubles) are exact."""
    most = (float(np.abs(a).max()) if a.size else 0.0) * (float(np.abs(b).max()) if b.size else 0.0) * max(1, a.shape[-1])
    return np.float64 if most < 2.0**53 else np.int64 if most < 2.0**62 else object


def whole(x: np.ndarray, kind) -> np.ndarray:
    """Doubles that are whole numbers in that type."""
    return np.array([int(v) for v in x.ravel().tolist()], object).reshape(x.shape) if kind is object else x.astype(kind)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers given as doubles."""
    kind = arithmetic(a, b)
    return whole(a, kind) @ whole(b, kind).T


def shrink(most: float) -> float:
    """A power of two by which distances may be scaled so that squares of components up to ``most`` stay finite."""
    return 1.0 if most < 2.0**400 else 2.0 ** (300 - math.frexp(most)[1])


def scaled(score: int, factor: float) -> float:
    """score * factor^2 for a whole number that may be too large for a double."""
    e = max(0, int(score).bit_length() - 60)
    return math.ldexp(float(int(score) >> e) * factor, e) * factor


class Tree:
    """Nodes as arrays: routing object, covering radius, distance to the parent's object, children or page.

    Rows are reordered so that a page is a slice; a node keeps its children's routing objects as one matrix. Distances
    are those of vectors times ``factor``.
    """

    def __init__(self, x: np.ndarray, extra: np.ndarray, page: int = PAGE, fanout: int = FANOUT, seed: int = 3, factor: float = 1.0):
        self.whole, self.factor, self.extra = x.astype(np.float64), factor, extra
        self.x = self.whole * factor
        self.norm = (self.x**2).sum(1)
        self.routing, self.radius, self.to_parent, self.children, self.pages = [], [], [], [], []
        self.page, self.fanout, self.rng, order = page, fanout, np.random.default_rng(seed), []
        self.root = self._load(np.arange(len(x)), None, order)
        self.rows = np.concatenate(order) if order else np.zeros(0, np.int64)  # place in the pages -> row
        self.paged, self.entry = self.whole[self.rows], np.zeros(len(self.rows))
        self.exact = {np.float64: self.paged}
        for node, page_ in enumerate(self.pages):
            if page_ is not None:
                self.entry[page_[0] : page_[1]] = self.distances(self.routing[node], self.rows[page_[0] : page_[1]])
        self.below = [(self.x[[self.routing[c] for c in cs]], np.array([self.radius[c] for c in cs]), np.array([self.to_parent[c] for c in cs])) if cs else None for cs in self.children]

    def distances(self, a: int, rows: np.ndarray) -> np.ndarray:
        """From row a to other rows, in the space with the extra component."""
        inner = self.x[rows] @ self.x[a]
        return np.sqrt(np.maximum(self.norm[a] + self.norm[rows] - 2 * inner + (self.extra[a] - self.extra[rows]) ** 2, 0))

    def _load(self, rows: np.ndarray, parent: int | None, order: list) -> int:
        centre = self.x[rows].mean(0)
        routing = int(rows[np.argmin(((self.x[rows] - centre) ** 2).sum(1))])
        node = len(self.routing)
        self.routing.append(routing)
        self.radius.append(float(self.distances(routing, rows).max()))
        self.to_parent.append(0.0 if parent is None else float(self.distances(parent, np.array([routing]))[0]))
        self.children.append([])
        self.pages.append(None)
        if len(rows) > self.page:
            pivots = self.rng.choice(rows, self.fanout, replace=False)
            near = np.stack([self.distances(int(p), rows) for p in pivots]).argmin(0)
            parts = [rows[near == k] for k in range(self.fanout)]
            if max(map(len, parts)) == len(rows):  # copies of one vector: nothing to tell apart
                parts = np.array_split(rows, -(-len(rows) // self.page))
            self.children[node] = [self._load(p, routing, order) for p in parts if len(p)]
        else:
            at = sum(map(len, order))
            self.pages[node] = (at, at + len(rows))
            order.append(rows)
        return node

    def search(self, q: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, bound: int | None, most: float):
        """(score, row) of the k best scores >= ``bound`` (ties to smaller ids), and how many distances were computed.

        ``own``: mask of rows that don't count; ``most``: the squared norm M^2, of scaled vectors.
        """
        kind = arithmetic(self.whole, q[None])
        if kind not in self.exact:
            self.exact[kind] = whole(self.paged, kind)
        paged, v, y = self.exact[kind], whole(q, kind), q * self.factor
        qq = float((y**2).sum())
        slack = 1e-6 * (1 + (qq + most) ** 0.5)
        reach = lambda s: max(0.0, qq + most - 2.0 * scaled(s, self.factor)) ** 0.5 * (1 + 1e-9) + slack
        best: list[tuple[int, int, int]] = []  # (score, -id, row), least first
        limit, least_score, computed = (math.inf, -math.inf, 1) if bound is None else (reach(bound), bound, 1)
        d = max(0.0, qq + most - 2.0 * float(self.x[self.routing[self.root]] @ y)) ** 0.5
        queue = [(max(0.0, d - self.radius[self.root]), self.root, d)]
        while queue:
            least, node, d = heapq.heappop(queue)
            if least > limit:
                break
            if self.pages[node] is not None:
                i, j = self.pages[node]
                near = np.flatnonzero(np.abs(self.entry[i:j] - d) <= limit)
                if not len(near):
                    continue
                score = (paged[i:j] @ v)[near] if len(near) * 2 > j - i else paged[i + near] @ v
                computed += len(near)
                good = np.flatnonzero(score >= least_score)
                for r, s in zip(self.rows[i + near[good]].tolist(), score[good].tolist()):
                    if own[r]:
                        continue
                    entry = (int(s), -int(ids[r]), r)
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                if len(best) == k:
                    least_score = max(least_score, best[0][0])
                    limit = min(limit, reach(least_score))
                continue
            vectors, radius, to_parent = self.below[node]
            able = np.flatnonzero(np.abs(to_parent - d) - radius <= limit)
            if len(able):
                to = np.sqrt(np.maximum(0.0, qq + most - 2.0 * (vectors[able] @ y)))
                computed += len(able)
                low = to - radius[able]
                for c, t, l in zip(able.tolist(), to.tolist(), low.tolist()):
                    if l <= limit:
                        heapq.heappush(queue, (max(0.0, l), self.children[node][c], t))
        return [(s, r) for s, _, r in sorted(best, reverse=True)], computed


def _placer(pivots: np.ndarray, factor: float):
    """Cell of each row, and its distance to the cell's pivot."""
    centre = pivots * factor
    own = (centre**2).sum(1)

    def run(batches):
        for batch in batches:
            x = matrix(batch.column("embedding")) * factor
            norm = (x * x).sum(1)
            square = norm[:, None] + own - 2 * x @ centre.T
            cell = square.argmin(1)
            d = np.sqrt(((x - centre[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("copy"), batch.column("embedding"), pa.array(norm), pa.array(cell.astype(np.int32)), pa.array(d)], names=["vec_id", "copy", "embedding", "norm", "cell", "d"])

    return run


def _asker(pivots: np.ndarray, cells: dict[int, float], ids: np.ndarray, points: np.ndarray, k: int, factor: float):
    """For each query its bound from the sample and the cells that can hold as good a score.

    In a cell of pivot p and radius r (plain distance), q.v <= q.p + |q| r.
    """
    known = np.array(sorted(cells))
    radius = np.array([cells[c] for c in known.tolist()])

    def run(batches):
        for batch in batches:
            q = matrix(batch.column("embedding"))
            y = q * factor
            length = np.sqrt((y * y).sum(1))
            reach = y @ (pivots[known] * factor).T + length[:, None] * radius * (1 + 1e-9)
            reach += 1e-9 * (1 + length[:, None] * (radius + np.sqrt(((pivots[known] * factor) ** 2).sum(1)))) + 1.0
            score, bounds, able = products(q, points), [], []
            for i, name in enumerate(batch.column("query_id").to_pylist()):
                others = score[i][ids != name]
                bound = None
                if len(others) >= k:
                    bound = int(sorted(others.tolist())[-k]) if others.dtype == object else int(np.partition(others, len(others) - k)[len(others) - k])
                    bound = min(bound, _MOST) if bound >= _LEAST else None  # a smaller bound is as right
                bounds.append(bound)
                able.append(known.astype(np.int32) if bound is None else known[reach[i] >= scaled(bound, factor)].astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("q"), batch.column("embedding"), pa.array(bounds, pa.int64()), pa.array(able, pa.list_(pa.int32()))], names=["query_id", "q", "embedding", "bound", "cells"])

    return run


_FOUND = "query_id long, q long, vec_id long, copy long, score long, high string"


def _searcher(k: int, most: float, factor: float):
    schema = pa.schema([(x, pa.int64()) for x in ("query_id", "q", "vec_id", "copy", "score")] + [("high", pa.string())])

    def run(rows, queries):
        out = []
        if len(rows) and len(queries):
            ids, copy, x = rows["vec_id"].to_numpy(), rows["copy"].to_numpy(), matrix(rows["embedding"])
            extra = np.sqrt(np.maximum(most - ((x * factor) ** 2).sum(1), 0))
            tree = Tree(x, extra, factor=factor)
            for name, number, bound, q in zip(queries["query_id"].to_pylist(), queries["q"].to_pylist(), queries["bound"].to_pylist(), matrix(queries["embedding"])):
                for s, r in tree.search(q, ids == name, ids, k, bound, most)[0]:
                    out.append((name, number, ids[r], copy[r], min(max(s, _LEAST), _MOST), None if _LEAST <= s <= _MOST else sortable(s)))
        return pa.Table.from_arrays([pa.array([o[c] for o in out], f.type) for c, f in enumerate(schema)], schema=schema)

    return run


def sortable(score: int) -> str:
    """Text that is larger for larger whole numbers beyond 64 bits of one sign."""
    digits = f"{abs(score):x}"
    text = f"{len(digits):05d}{digits}"
    return text if score > 0 else text.translate({ord(a): b for a, b in zip("0123456789abcdef", "fedcba9876543210")})


_RESULT = "query_id long, rank int, vec_id long, score long"


def neighbours(embeddings: DataFrame, every: int = 50, k: int = 5, scale: int = 256, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k highest inner products of every row whose id is divisible by ``every``."""
    ship(embeddings.sparkSession)
    # Doubles of 2^52 and more are whole numbers, and floor() gives 64-bit integers.
    down = lambda x: F.when(F.abs(x * scale) < 2.0**52, F.floor(x * scale).cast("double")).otherwise(x * scale)
    rows = usable(embeddings, "vec_id", "embedding", False).where("vec_id is not null").withColumn("embedding", F.transform("embedding", down))
    return by_dimension(usable(rows, "vec_id", "embedding", False), lambda own, _: _neighbours(own, every, k, block), _RESULT)


def _neighbours(rows: DataFrame, every: int, k: int, block: int) -> DataFrame:
    ids, points = sample(rows, SAMPLE)
    total, largest = rows.agg(F.count("*"), F.max(F.array_max(F.transform("embedding", F.abs)))).first()
    factor = shrink(largest)
    rows = rows.withColumn("copy", F.monotonically_increasing_id())
    distinct = np.unique(points, axis=0)
    pivots = distinct[np.random.default_rng(5).permutation(len(distinct))[: max(1, min(CELLS, total // block))]]
    placed = durable(rows.mapInArrow(_placer(pivots, factor), "vec_id long, copy long, embedding array<double>, norm double, cell int, d double"), "cells")
    told = placed.groupBy("cell").agg(F.max("d").alias("radius"), F.count("*").alias("n"), F.max("norm").alias("most")).collect()  # at most CELLS rows
    most = max(r["most"] for r in told)
    pieces = F.create_map(*[F.lit(x) for r in told for x in (r["cell"], -(-r["n"] // block))])
    queries = placed.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("copy").alias("q"), "embedding")
    asked = queries.mapInArrow(_asker(pivots, {r["cell"]: r["radius"] for r in told}, ids, points, k, factor), "query_id long, q long, embedding array<double>, bound long, cells array<int>")
    asked = asked.select("query_id", "q", "embedding", "bound", F.explode("cells").alias("cell"))
    asked = asked.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces[F.col("cell")].cast("long") - 1)))
    blocks = placed.withColumn("piece", F.pmod(F.xxhash64("copy"), pieces[F.col("cell")].cast("long"))).select("cell", "piece", "vec_id", "copy", "embedding")
    scores = blocks.groupBy("cell", "piece").cogroup(asked.groupBy("cell", "piece")).applyInArrow(_searcher(k, most, factor), _FOUND)
    return top(scores, k, F.desc_nulls_last("high"))
