"""Byte-level BPE encoding and decoding on padded numpy matrices.

Texts are split by the vocabulary's pattern. Distinct pieces that a worker doesn't know yet are dealt into buckets by
length and become rows of a padded matrix of ids. Each round finds every row's leftmost pair of least rank, replaces
it, closes the gap (compaction along the row) and takes finished rows out (compaction of rows). Ranks of pairs come from
an open-addressing hash table in numpy arrays, built from all splits of all tokens into two tokens. A piece of more than
``LONG`` bytes is a matrix of one row, which in a round makes all those merges of its least rank, from the left, that
one a round would make one after the other: up to the first that brings about a pair of lesser rank.

Null text counts as empty: no ids. Null doc_ids and repeated rows keep their rows; an empty table gives an empty result.
Other columns of the input are ignored, whatever their names. Very long texts are split and merged like others.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import ship

LONG, ROWS, CACHED_PIECES, TEXT_CHARS = 384, 16384, 300_000, 4 << 20
NONE = np.int64(1 << 40)


class PairTable:
    """(left id, right id) -> id of the merged token, by multiplicative hashing and linear probing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 2.5))))
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int64)
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            _, one = np.unique(at[free], return_index=True)
            placed = free[one]
            self.keys[at[placed]], self.values[at[placed]] = keys[placed], values[placed]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (len(self.keys) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, NONE where two ids don't merge (negative ids never do)."""
        keys = (left.astype(np.int64) << 32 | right).ravel()
        out = np.full(len(keys), NONE)
        open_ = np.flatnonzero((left >= 0).ravel() & (right >= 0).ravel())
        at = self._home(keys[open_])
        while len(open_):
            held = self.keys[at]
            hit = held == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            on = ~hit & (held >= 0)
            open_, at = open_[on], (at[on] + 1) & (len(self.keys) - 1)
        return out.reshape(left.shape)


class Encoder:
    """Encodes and decodes with the ranks of one file; keeps a bounded number of pieces."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [(self.ranks[t[:i]] << 32 | self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.pairs = PairTable(*(np.array(x, np.int64) for x in zip(*pairs))) if pairs else PairTable(np.zeros(0, np.int64), np.zeros(0, np.int64))
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for t, r in self.ranks.items():
            tokens[r] = t
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_start = np.r_[0, np.cumsum([len(t) for t in tokens])]
        self.clear()

    def clear(self):
        self.place: dict[str, int] = {}
        self.flat, self.start = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        self.count = [np.zeros(0, np.int64)]
        self.used = 0

    def _rows(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """Ids of pieces of at most ``width`` bytes."""
        size = np.array([len(p) for p in pieces])
        ids = np.full((len(pieces), width), -1, np.int64)
        ids[np.arange(width) < size[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        out: list[np.ndarray] = [None] * len(pieces)  # type: ignore[list-item]
        row = np.arange(len(pieces))
        rank = self.pairs(ids[:, :-1], ids[:, 1:])
        while True:
            at = rank.argmin(1) if rank.shape[1] else np.zeros(len(row), np.int64)
            best = rank[np.arange(len(row)), at] if rank.shape[1] else np.full(len(row), NONE)
            done = best >= NONE
            if done.any():
                for r, x, n in zip(row[done].tolist(), ids[done], (ids[done] >= 0).sum(1).tolist()):
                    out[r] = x[:n].astype(np.uint32)
                on = ~done
                row, ids, rank, at, best = row[on], ids[on], rank[on], at[on], best[on]
            if not len(row):
                return out
            here = np.arange(len(row))
            ids[here, at] = best
            after = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, after + (after > at[:, None]), 1)
            after = np.arange(ids.shape[1] - 1)
            rank = np.take_along_axis(rank, after + (after >= at[:, None]), 1)
            back = at > 0
            rank[here[back], at[back] - 1] = self.pairs(ids[here[back], at[back] - 1], ids[here[back], at[back]])
            ahead = at < ids.shape[1] - 1
            rank[here[ahead], at[ahead]] = self.pairs(ids[here[ahead], at[ahead]], ids[here[ahead], at[ahead] + 1])

    def _long(self, piece: bytes) -> np.ndarray:
        """Ids of one long piece."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        rank = self.pairs(ids[:-1], ids[1:])
        while len(rank) and (least := rank.min()) < NONE:
            at = np.flatnonzero(rank == least)
            # Of overlapping pairs every second one, from the left of their run.
            run = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) % 2 == 0]
            left = np.where(at > 0, ids[at - 1], -1)
            left[1:] = np.where(at[1:] == at[:-1] + 2, least, left[1:])  # the merge before is its neighbour
            right = np.where(at + 2 < len(ids), ids[np.minimum(at + 2, len(ids) - 1)], -1)
            merged = np.full(len(at), least)
            lesser = np.flatnonzero((self.pairs(left, merged) < least) | (self.pairs(merged, right) < least))
            at = at[: lesser[0] + 1] if len(lesser) else at
            ids[at] = least
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, rank = ids[keep], np.r_[rank, NONE][keep][:-1]
            at -= np.arange(len(at))
            near = np.unique(np.r_[at - 1, at])
            near = near[(near >= 0) & (near < len(rank))]
            rank[near] = self.pairs(ids[near], ids[near + 1])
        return ids.astype(np.uint32)

    def pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        size = np.array([len(p) for p in pieces])
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(pieces)
        bounds = [0, 2, 4, 6, 8, 11, 16, 24, 40, 72, 136, 264, LONG]
        for low, high in zip(bounds, bounds[1:]):
            own = np.flatnonzero((size > low) & (size <= high))
            step = max(1, min(ROWS, (1 << 20) // high))
            for i in range(0, len(own), step):
                for k, ids in zip(own[i : i + step].tolist(), self._rows([pieces[k] for k in own[i : i + step]], high)):
                    out[k] = ids
        for k in np.flatnonzero(size > LONG).tolist():
            out[k] = self._long(pieces[k])
        return out

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        found = [self.pattern.findall(t) for t in texts]
        fresh = list({p for f in found for p in f if p not in self.place})
        if fresh and len(self.place) + len(fresh) > CACHED_PIECES:
            self.clear()
            fresh = list({p for f in found for p in f})
        if fresh:
            ids = self.pieces([p.encode() for p in fresh])
            count = np.array([len(x) for x in ids])
            self.place.update(zip(fresh, range(len(self.place), len(self.place) + len(fresh))))
            self.flat.append(np.concatenate(ids))
            self.count.append(count)
            self.start.append(self.used + np.r_[0, np.cumsum(count)][:-1])
            self.used += int(count.sum())
            self.flat, self.count, self.start = ([np.concatenate(x)] for x in (self.flat, self.count, self.start))
        place = np.fromiter(map(self.place.__getitem__, chain.from_iterable(found)), np.int64, sum(map(len, found)))
        count = self.count[0][place]
        before = np.r_[0, np.cumsum(count)]
        ids = self.flat[0][np.repeat(self.start[0][place] - before[:-1], count) + np.arange(before[-1])]
        bounds = before[np.r_[0, np.cumsum([len(f) for f in found])]]
        return [ids[i:j] for i, j in zip(bounds[:-1], bounds[1:])]

    def decode(self, ids: np.ndarray) -> bytes:
        start = self.token_start[ids]
        count = self.token_start[ids.astype(np.int64) + 1] - start
        before = np.cumsum(count) - count
        return self.token_bytes[np.repeat(start - before, count) + np.arange(int(count.sum()))].tobytes()


@lru_cache(2)
def worker_encoder(path: str, pattern: str) -> Encoder:
    """One encoder for all tasks of a worker process; ids of pieces are kept for a task only."""
    return Encoder(path, pattern)


def _groups(column: pa.Array):
    """Texts in lists of about TEXT_CHARS characters."""
    group, held = [], 0
    for value in column:
        text = value.as_py() or ""
        group.append(text)
        held += len(text)
        if held >= TEXT_CHARS:
            yield group
            group, held = [], 0
    if group:
        yield group


def encode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids)``: every text's ids, as binary little-endian unsigned 32-bit integers."""

    def run(batches):
        encoder = worker_encoder(path, pattern)
        for batch in batches:
            at = 0
            for group in _groups(batch.column("text")):
                ids = [x.astype("<u4").tobytes() for x in encoder.texts(group)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(group)), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
                at += len(group)
        encoder.clear()  # idle workers of later stages would hold it

    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids, bytes)`` from ``(doc_id, ids)``; null ids give no bytes."""

    def run(batches):
        encoder = worker_encoder(path, pattern)
        for batch in batches:
            ids = batch.column("ids")
            out = [encoder.decode(np.frombuffer(x.as_py() or b"", "<u4")) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(out, pa.binary())], names=["doc_id", "ids", "bytes"])

    ship(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, bytes binary")


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: encodes and decodes every text."""
    both = decode(encode(documents, path, pattern), path, pattern)
    return both.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
