"""Best-fit packing of tokenised documents into sequences of bounded length.

Every document's ids (and a closing id 0) are cut into pieces of at most ``CAPACITY`` ids; only longer documents are
cut. A full piece is a sequence. All others are packed by vector best-fit in decreasing order of length: a sequence has
residual capacities for tokens, documents and attention cost (the sum of squared piece lengths), all of which a piece
must fit; among those that fit, the one of least weighted residual norm after placing (or of largest weighted dot
product of residual and demand) takes it.

Packing is global: tasks tokenise and write the pieces' lengths, a histogram of at most ``CAPACITY`` lengths comes to
the driver, and ``plan`` packs it, with runs of alike sequences as one; then each piece looks up its place by its length
and its rank among all pieces of that length. So the number of sequences depends neither on the order of the rows nor
on how they are dealt to tasks, and memory is bounded by the number of lengths. Sequence numbers begin at 0.

A word, or part of one that the tokenizer would cut off anyway, is tokenised once per worker and its ids are reused,
which gives the same ids as the whole text, since the tokenizer's pieces span neither white space nor such cuts; units
are told apart by their bytes. A text that holds a special token's string is tokenised as a whole, in which the
tokenizer's own call makes it that token (``ordinary``: its characters instead).

Null text counts as empty: one piece, id 0 alone. Very long texts are cut like others. Null doc_ids and repeated rows
get their own pieces. Ties: of equally good sequences the one begun first. An empty table gives an empty result. Other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import durable, ship
from .shingles import slices, span_hashes, utf8_buffers

CAPACITY, CACHED_WORDS = 2048, 800_000
#: 0 white space, 1 letters, 2 other ASCII characters, 3 all else
_KIND = np.full(256, 2, np.uint8)
_KIND[[32, *range(9, 14)]] = 0
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[[39, *range(128, 256)]] = 3
WEIGHTS = (1.0, 0.01, 0.1)


def unit_spans(raw: np.ndarray, offsets: np.ndarray):
    """Begin and end of each unit, whether it is all letters, and each document's first unit.

    A unit is a word or, where that surely doesn't change its ids, a part of one: words are cut between letters (ASCII
    and Latin-1) and other ASCII characters, except at apostrophes.
    """
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(bool), np.zeros(len(offsets), np.int64)
    kind = _KIND[raw]
    if n > 1:
        latin = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] != 0x97) & (raw[1:] != 0xB7))
        kind[latin] = kind[latin + 1] = 1
    cut = np.zeros(n + 1, bool)
    cut[offsets[offsets <= n]] = True
    cut[1:n] |= (kind[1:] != kind[:-1]) & ((kind[1:] == 0) | (kind[:-1] == 0) | (kind[1:] + kind[:-1] == 3) & (kind[1:] != 3) & (kind[:-1] != 3))
    cut[n] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    own = (kind[starts] > 0) & (ends > starts)
    starts, ends = starts[own], ends[own]
    letters = np.r_[0, np.cumsum(kind == 1)]
    return starts, ends, letters[ends] - letters[starts] == ends - starts, np.searchsorted(starts, offsets)


def _eight(raw: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes at ``at``, ``size`` of them but 8 at most, as numbers."""
    out = np.zeros(len(at), np.uint64)
    for k in range(8):
        out |= np.where(k < size, raw[np.minimum(at + k, max(len(raw) - 1, 0))], 0).astype(np.uint64) << np.uint64(8 * k)
    return out


class WordIds:
    """Ids of units of text, kept from slice to slice up to a bounded number of units."""

    def __init__(self, path: str, ordinary: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.own = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.special = [] if ordinary else [t.content.encode() for t in self.own.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self):
        self.place: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0
        self.start, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(count.sum())), count

    def _add(self, keys: list[bytes], units: list[str], letters: bool):
        if letters:  # each is one word to the tokenizer, so its ids end where a word-end id stands
            ids, _ = self._encoded([" ".join(units[i : i + 500]) for i in range(0, len(units), 500)])
            count = np.diff(np.r_[-1, np.flatnonzero(self.ends_word[ids])])
            if len(count) != len(units) or count.sum() != len(ids):
                ids, count = self._encoded(units)
        else:
            ids, count = self._encoded(units)
        k = len(self.place)
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(ids)), np.uint32)])
        if k + len(units) > len(self.start):
            self.start, self.count = (np.concatenate([x, np.zeros(max(len(x), len(units)), np.int64)]) for x in (self.start, self.count))
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[k : k + len(units)], self.count[k : k + len(units)] = self.used + np.cumsum(count) - count, count
        self.place.update(zip(keys, range(k, k + len(units))))
        self.used += len(ids)

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All documents' ids, each closed by id 0, and their bounds."""
        text = raw.tobytes()
        ids, bounds = self._by_units(text, raw, offsets)
        whole = {int(np.searchsorted(offsets, at, "right")) - 1 for t in self.special for at in _found(text, t)}
        if whole:
            parts = [ids[i:j] for i, j in zip(bounds[:-1], bounds[1:])]
            for d in whole:
                parts[d] = np.array([*self.own.encode(text[offsets[d] : offsets[d + 1]].decode(), add_special_tokens=False).ids, 0], np.uint32)
            ids, bounds = np.concatenate(parts), np.r_[0, np.cumsum([len(p) for p in parts])]
        return ids, bounds

    def _by_units(self, text: bytes, raw: np.ndarray, offsets: np.ndarray):
        starts, ends, letters, first = unit_spans(raw, offsets)
        hashes, at, of = np.unique(span_hashes(raw, starts, ends) if len(starts) else np.zeros(0, np.uint64), return_index=True, return_inverse=True)
        size, same = ends - starts, at[of]
        equal = size == size[same]
        for x in (starts, np.maximum(ends - 8, starts)):
            parts = _eight(raw, x, size)
            equal &= parts == parts[same]
        long = np.flatnonzero(equal & (size > 16))
        spans = zip(long.tolist(), starts[long].tolist(), ends[long].tolist(), starts[same[long]].tolist(), ends[same[long]].tolist())
        other = np.r_[np.flatnonzero(~equal), np.array([k for k, i, j, a, b in spans if text[i:j] != text[a:b]], np.int64)].astype(np.int64)
        if len(other):  # equal hashes of different units: each occurrence stands for itself
            of[other] = len(at) + np.arange(len(other))
            at = np.r_[at, other]
        keys = [text[i:j] for i, j in zip(starts[at].tolist(), ends[at].tolist())]
        if len(self.place) + len(keys) > CACHED_WORDS:
            self.clear()
        place = np.fromiter(map(self.place.get, keys, repeat(-1)), np.int64, len(keys))
        if (place < 0).any():
            for kind in (True, False):
                new = list({keys[k]: None for k in np.flatnonzero((place < 0) & (letters[at] == kind)).tolist()})
                if new:
                    self._add(new, [u.decode("utf-8", "replace") for u in new], kind)
            place = np.fromiter(map(self.place.__getitem__, keys), np.int64, len(keys))
        place = place[of]
        count = self.count[place]
        before = np.r_[0, np.cumsum(count)]
        total = int(before[-1])
        ids = self.flat[np.repeat(self.start[place] - before[:-1], count) + np.arange(total)]
        bounds = before[first]  # in ids without the closing ones
        documents = len(offsets) - 1
        out = np.zeros(total + documents, np.uint32)
        out[np.arange(total) + np.repeat(np.arange(documents), np.diff(bounds))] = ids
        return out, bounds + np.arange(documents + 1)


def _found(text: bytes, part: bytes):
    at = text.find(part)
    while at >= 0:
        yield at
        at = text.find(part, at + 1)


@lru_cache(2)
def worker_words(path: str, ordinary: bool) -> WordIds:
    """One tokenizer for all tasks of a worker process; ids of units are kept for a task only."""
    return WordIds(path, ordinary)


def best_fit(demand: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str = "norm") -> np.ndarray:
    """Bin of each item (rows of ``demand``), in the order given; no capacity is exceeded. Items must fit an empty bin."""
    n, dims = demand.shape
    load, room, scale = demand / capacity, np.ones((n + 1, dims)), np.asarray(weights, float)
    name = np.zeros(n + 1, np.int64)
    live = made = 0
    least = np.minimum.accumulate(load[::-1, 0])[::-1]  # the smallest item that is still to come
    out = np.zeros(n, np.int64)
    for k in range(n):
        item = load[k]
        fits = np.flatnonzero((room[:live] >= item - 1e-12).all(1))
        if len(fits):
            if rule == "norm":
                rest = room[fits] - item
                b = fits[np.argmin((rest * rest) @ scale)]
            else:
                b = fits[np.argmax((room[fits] * item) @ scale)]
        else:
            b, live = live, live + 1
            room[b], name[b] = 1.0, made
            made += 1
        room[b] -= item
        out[k] = name[b]
        if room[b, 0] < least[min(k + 1, n - 1)] - 1e-12:  # nothing will fit: the last open bin takes its place
            live -= 1
            room[b], name[b] = room[live], name[live]
    return out


def plan(lengths: list[int], counts: list[int], capacity: int = CAPACITY, most_documents: int = CAPACITY, most_cost: float = CAPACITY * CAPACITY, weights=WEIGHTS, rule: str = "norm") -> np.ndarray:
    """What ``best_fit`` does with ``counts`` pieces of each of ``lengths`` (falling), many alike sequences at a time.

    Rows (length, first rank, first sequence, pieces a sequence, offset of the first): pieces of that length, by rank
    from the first, go to consecutive sequences, so many to each.
    """
    whole, scale = np.array([capacity, most_documents, most_cost], float), np.asarray(weights, float)
    room, first, many, used = np.zeros((0, 3)), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    out, made = [], 0
    for at, (length, left) in enumerate(zip(lengths, counts)):
        item, rank = np.array([length, 1.0, length * length]), 0
        while left:
            fits = np.flatnonzero((room >= item).all(1))
            if not len(fits):
                new = -(-left // int((whole // item).min()))
                room, first, many, used = np.vstack([room, whole]), np.r_[first, made], np.r_[many, new], np.r_[used, 0]
                made += new
                fits = np.array([len(first) - 1])
            if rule == "norm":
                b = fits[np.argmin(((room[fits] - item) / whole) ** 2 @ scale)]
                each = int((room[b] // item).min())  # the one just filled stays the best for the next of its length
            else:
                b, each = fits[np.argmax((room[fits] / whole * (item / whole)) @ scale)], 1
            each = min(each, left)
            n = min(int(many[b]), left // each)
            out.append((length, rank, int(first[b]), each, int(used[b])))
            if n < many[b]:  # the others stay as they were
                room, first, many, used = np.vstack([room, room[b]]), np.r_[first, first[b] + n], np.r_[many, many[b] - n], np.r_[used, used[b]]
                many[b] = n
            room[b] -= each * item
            used[b] += each * length
            rank, left = rank + n * each, left - n * each
        if at + 1 < len(lengths):
            open_ = room[:, 0] >= min(lengths[at + 1 :])
            room, first, many, used = room[open_], first[open_], many[open_], used[open_]
    return np.array(sorted(out), np.int64).reshape(-1, 5)


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"
_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]


def _cutter(path: str, capacity: int, ordinary: bool):
    """Pieces of documents, each with its task and its rank among the task's pieces of its length."""

    def run(batches):
        encode = worker_words(path, ordinary)
        context = TaskContext.get()
        task = context.partitionId() if context else 0
        seen = [0] * (capacity + 1)
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            raw, offsets = utf8_buffers(batch.column("text"))
            for begin, _, part, cut in slices(raw, offsets):
                ids, bounds = encode(part, cut)
                rows = []
                for d, (i, j) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    for k, at in enumerate(range(i, j, capacity)):
                        own = ids[at : min(at + capacity, j)]
                        rows.append((names[begin + d], k, at - i, len(own), zlib.crc32(own.astype("<u4").tobytes()), task, seen[len(own)]))
                        seen[len(own)] += 1
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[*_NAMES, "part", "nth"])
        encode.clear()  # idle workers of later stages would hold it

    return run


def _placer(places: np.ndarray):
    """Pieces with their sequence and offset, by length and rank."""
    keys = places[:, 0] << 44 | places[:, 1]

    def run(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            own = places[np.searchsorted(keys, length << 44 | rank, "right") - 1] if len(length) else places[:0]
            nth = rank - own[:, 1]
            columns = [pa.array(own[:, 2] + nth // own[:, 3]), pa.array(own[:, 4] + nth % own[:, 3] * length)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _NAMES), *columns], names=[*_NAMES, "sequence_id", "offset"])

    return run


def pack(documents: DataFrame, path: str, capacity: int = CAPACITY, most_documents: int = CAPACITY, most_cost: float = CAPACITY * CAPACITY, weights=WEIGHTS, rule: str = "norm", ordinary: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece of ``documents(doc_id, text)``.

    The default bounds on documents and attention cost never bind before that on tokens does; smaller ones must leave
    room for a single piece of ``capacity`` ids.
    """
    if most_documents < 1 or most_cost < capacity * capacity:
        raise ValueError("a single full piece must fit a sequence")
    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = durable(rows.mapInArrow(_cutter(path, capacity, ordinary), _PIECES), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = sorted(((r["length"], r["n"]) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()), reverse=True)
    places = plan([x for x, _ in histogram], [n for _, n in histogram], capacity, most_documents, most_cost, weights, rule)
    # A piece's rank: the pieces of its length in earlier tasks, then its own task's.
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).drop("n")
    ranked = pieces.join(before, ["part", "length"]).select(*_NAMES, (F.col("before") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(_placer(places), _SCHEMA)
