"""Periodic runs of words, found on a harmonic grid by longest common extensions.

A run of period p and length 2 p or more holds two neighbouring points j p and (j + 1) p of the grid of p, so the longest
common extensions of such points, forward and backward, give every run's borders. They come from a suffix array of the
words, one of the reversed words, and range minima over common prefixes of neighbouring suffixes. Points whose words
differ can't lie in a run and are skipped; for periods of fewer than 5 a run of ``LEAST`` words holds several points, of
which every so-many-th is asked. A multiple of a run's period finds the same borders, so of equal borders the least
period stays. Cost for n words: n log n points, n log n for the arrays, memory a fixed number of integers a word (and
one more for each doubling that a repeated passage needs).

Short documents share one suffix array of about ``BATCH_WORDS`` words: equal words of different documents are different
symbols, so nothing extends across documents. Rows need no shuffle; a text is one task's whatever its length.

Null and empty texts, and texts of separators only, have no words and no run. Ties: of the longest runs the one of
least start, then of least period. Repeated rows and null doc_ids keep their rows; a null doc_id damages nothing. An empty
table gives an empty result. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import ship

LEAST, BATCH_WORDS, CHUNK = 12, 1 << 16, 1 << 20
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64())]
    + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
)


def suffix_ranks(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rank of every suffix, and for each k the ranks by the first 2^k symbols, by prefix doubling.

    A rank is the number of lesser suffixes, so a doubling moves only those that still share theirs.
    """
    n = len(symbols)
    counts = np.bincount(symbols, minlength=1)
    rank = (np.cumsum(counts) - counts)[symbols]
    levels, width, shared = [rank.astype(np.int32)], 1, np.flatnonzero(counts[symbols] > 1)
    while len(shared):
        after = shared + width
        key = rank[shared] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        shared, key = shared[order], key[order]
        old = rank[shared]
        new, fresh = np.ones(len(key), bool), np.ones(len(key), bool)
        new[1:], fresh[1:] = key[1:] != key[:-1], old[1:] != old[:-1]
        place = np.arange(len(key))
        own = np.maximum.accumulate(np.where(new, place, 0))
        rank[shared] = old + own - np.maximum.accumulate(np.where(fresh, place, 0))
        levels.append(rank.astype(np.int32))
        bounds = np.r_[np.flatnonzero(new), len(key)]
        shared = np.sort(shared[np.repeat(np.diff(bounds) > 1, np.diff(bounds))])
        width *= 2
    return rank, levels


class Extensions:
    """Longest common extensions of two places of a text, by its suffix array."""

    BLOCK = 16

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.rank, levels = suffix_ranks(symbols)
        order = np.empty(n, np.int64)
        order[self.rank] = np.arange(n)
        common = np.zeros(-(-n // self.BLOCK) * self.BLOCK or self.BLOCK, np.int32)
        if n > 1:
            pairs = np.flatnonzero(levels[0][order[:-1]] == levels[0][order[1:]])
            a, b, length = order[pairs], order[pairs + 1], np.zeros(len(pairs), np.int64)
            for k in range(len(levels) - 1, -1, -1):
                ranks = np.append(levels.pop(), np.int32(-1))
                length += (ranks[np.minimum(a + length, n)] == ranks[np.minimum(b + length, n)]).astype(np.int64) << k
            common[pairs + 1] = length
        # Range minima: inside blocks from both ends, and a sparse table over the blocks.
        self.common = common
        blocks = common.reshape(-1, self.BLOCK)
        self.heads = np.minimum.accumulate(blocks, 1).ravel()
        self.tails = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        self.table = [blocks.min(1)]
        while len(self.table[-1]) > 1 << len(self.table) - 1:
            last, step = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(last[:-step], last[step:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least common prefix from rank ``low`` to ``high``."""
        first, last = low // self.BLOCK, high // self.BLOCK
        out = np.minimum(self.tails[low], self.heads[high])
        inner = np.flatnonzero(last - first > 1)
        if len(inner):
            begin, count = first[inner] + 1, (last - first)[inner] - 1
            power = np.frexp(count)[1] - 1
            for k in np.unique(power):
                of = power == k
                where = inner[of]
                out[where] = np.minimum(out[where], np.minimum(self.table[k][begin[of]], self.table[k][begin[of] + count[of] - (1 << k)]))
        same = np.flatnonzero(first == last)
        if len(same):
            at, to = low[same], high[same]
            found = self.common[at]
            for k in range(1, self.BLOCK):
                found = np.minimum(found, self.common[np.minimum(at + k, to)])
            out[same] = found
        return out

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` and from ``b`` on agree; a and b differ."""
        x, y = self.rank[a], self.rank[b]
        return self.least(np.minimum(x, y) + 1, np.maximum(x, y)).astype(np.int64)


def grid(symbols: np.ndarray, longest: int, least: int = LEAST):
    """Chunks (point, period) of the harmonic grid whose words agree with those a period later."""
    n, dense = len(symbols), min(longest, 64)
    for p in range(1, dense + 1):
        step = p * max(1, (least - p) // p)
        a = np.flatnonzero(symbols[:-p:step] == symbols[p::step][: len(symbols[:-p:step])]) * step
        for k in range(0, len(a), CHUNK):
            yield a[k : k + CHUNK], np.full(len(a[k : k + CHUNK]), p)
    p = dense + 1
    while p <= longest:
        q = min(longest + 1, p + max(1, CHUNK // (n // p + 1)))
        periods = np.arange(p, q)
        counts = -(-(n - periods) // periods)
        period = np.repeat(periods, counts)
        a = (np.arange(len(period)) - np.repeat(np.cumsum(counts) - counts, counts)) * period
        equal = symbols[a] == symbols[a + period]
        yield a[equal], period[equal]
        p = q


def runs(symbols: np.ndarray, longest: int, least: int = LEAST) -> np.ndarray:
    """Rows (start, end, period) of all runs with periods up to ``longest``, by start and period."""
    found, held, most, forward, backward = [], 0, 4 * CHUNK, None, None
    n = len(symbols)

    def merged() -> np.ndarray:
        rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
        return rows[new]

    for a, p in grid(symbols, longest, least):
        if not len(a):
            continue
        if forward is None:
            forward, backward = Extensions(symbols), Extensions(symbols[::-1])
        end = a + p + forward.of(a, a + p)
        start = a.copy()
        inner = np.flatnonzero(a > 0)
        start[inner] -= backward.of(n - a[inner], n - a[inner] - p[inner])
        good = end - start >= np.maximum(least, 2 * p)
        if good.any():
            found.append(np.stack([start[good], end[good], p[good]], 1))
            held += int(good.sum())
            if held > most:
                found = [merged()]
                held = len(found[0])
                most = max(most, 2 * held)
    rows = merged()
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def damaged(words: list[bytes], h: int | None) -> list[bytes]:
    """The words, made periodic from one of them on for a tenth of all hashes."""
    n = len(words)
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def describe(texts: list[list[bytes]]) -> list[tuple]:
    """``(n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)`` of each list of words."""
    symbols, base = [], 0
    for words in texts:
        numbers: dict[bytes, int] = {}
        symbols.extend([base + numbers.setdefault(w, len(numbers)) for w in words])
        base += len(numbers)
    bounds = np.cumsum([0, *map(len, texts)])
    rows = runs(np.array(symbols, np.int64), int(np.diff(bounds).max(initial=0)) // 2)
    cuts = np.searchsorted(rows[:, 0], bounds)
    depth = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(depth, rows[:, 0] + rows[:, 2], 1)
    np.add.at(depth, rows[:, 1], -1)
    kept = np.cumsum(depth)[:-1] <= 0
    out = []
    for k, words in enumerate(texts):
        own = rows[cuts[k] : cuts[k + 1]]
        listing, first = "", (None, None, None, None)
        if len(own):
            start, length, period = own[:, 0] - bounds[k], own[:, 1] - own[:, 0], own[:, 2]
            listing = "".join(f"{s},{n},{p}\n" for s, n, p in zip(start.tolist(), length.tolist(), period.tolist()))
            best = int(np.argmax(length))  # the first of the longest, as rows go by start and period
            n, p = int(length[best]), int(period[best])
            first = (int(start[best]), n, p, 1000 * n // p)
            words = [words[i] for i in np.flatnonzero(kept[bounds[k] : bounds[k + 1]])]
        out.append((len(own), *first, hashlib.sha256(listing.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()))
    return out


def _describe(batches):
    ids, texts, held = [], [], 0

    def flush():
        columns = [ids, *zip(*describe(texts))]
        return pa.RecordBatch.from_arrays([pa.array(list(c), field.type) for c, field in zip(columns, _SCHEMA)], schema=_SCHEMA)

    for batch in batches:
        for doc, raw, h in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("h").to_pylist()):
            words = damaged((raw.as_py() or b"").split(), h)  # bytes split at 0x20 and 0x09-0x0D
            if texts and held + len(words) > BATCH_WORDS:
                yield flush()
                ids, texts, held = [], [], 0
            ids.append(doc)
            texts.append(words)
            held += len(words)
    if texts:
        yield flush()


def periodic_runs(documents: DataFrame, damage: bool = True) -> DataFrame:
    """Each document's runs: their number, the longest, digests of all of them and of the text without repetitions.

    ``damage``: first make the words of a tenth of all documents periodic, by the crc32 of their doc_id.
    """
    ship(documents.sparkSession)
    key = F.col("doc_id").cast("long")
    h = F.crc32(F.col("doc_id").cast("string")) if damage else F.lit(None).cast("long")
    rows = documents.select(key.alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"), h.alias("h"))
    text = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return rows.mapInArrow(_describe, text)


def run_spans(documents: DataFrame) -> DataFrame:
    """``(doc_id, start, length, period)``: every run of the texts as they are, by number of word."""

    def spans(batches):
        for batch in batches:
            out = []
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                numbers: dict[bytes, int] = {}
                symbols = np.array([numbers.setdefault(w, len(numbers)) for w in (raw.as_py() or b"").split()], np.int64)
                out += [(doc, int(s), int(e - s), int(p)) for s, e, p in runs(symbols, len(symbols) // 2)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(4)], names=["doc_id", "start", "length", "period"])

    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(spans, "doc_id long, start long, length long, period long")
