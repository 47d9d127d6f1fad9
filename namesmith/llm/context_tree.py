"""Language-model scores by context-tree weighting over bytes, beside a unigram baseline.

A text is its bytes with A-Z in lower case and one end symbol. Each byte is eight binary choices; choice z (the bits so
far) has a binary-valued context tree over the last ``DEPTH`` bytes (before the text: end symbols). A context s holds
the zeros and ones seen after it in training, its Krichevsky-Trofimov estimate Pe(s), and the weighted probability
Pw(s) = (Pe(s) + product of Pw over the contexts one byte longer) / 2, Pw = Pe at full depth. A choice's probability is
the ratio of the root's Pw with and without it, which is a mixture of the estimates along its path: the weight to stop
at s is Pe(s) / 2 Pw(s). The model is fixed after training, so a text's score doesn't depend on other scored texts.

All of this follows from counts of (context, next byte) over the whole training corpus:

1. Tasks put documents together as packs of about ``PACK`` bytes; a pack's distinct grams (context and byte) and words go
   to ranges of their hashes, whose number follows an estimate of all distinct ones, and are counted there.
2. Grams, sorted by their context's last bytes first, stream through tasks by the last two: nodes below are summed up
   there, those above (65,280 at most, by their number) on the driver; a second stream goes back down with the weights of
   all shorter contexts and gives each gram its log probability. Grams that only held-out texts have go along with count 0.
3. Ranges answer each pack's grams and words; packs add them up by document.

Neither the corpus nor the model is ever in one place: a task holds a pack, a range's table, or the grams of some contexts
of three bytes. Words and grams are told apart by 64 bits (grams are 48 bits, exact).

Null and empty texts are one end symbol and one end token. A null doc_id isn't held out. Repeated rows keep their rows
and count each. Without training documents every choice has probability 1/2 and the baseline is 0. A text over the
pack's size is a pack of its own. Ties don't occur. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import durable, holds_out, release, ship
from .shingles import _LOWER, mix, span_hashes, word_spans

DEPTH, PACK, RANGE, SLICE, SAMPLE = 5, 16 << 20, 1 << 20, 1 << 16, 10
END = 255
_GRAM, _WORD, _DATA = 0, 1, 2
_GAP = np.zeros(256, bool)
_GAP[[32, 9, 10, 11, 12, 13, END]] = True
_LN2, _LNPI = np.log(2), np.log(np.pi)


# Packs: texts in lower case, each after and before ``depth`` end symbols.


def compressed(x: np.ndarray) -> bytes:
    import zstandard

    return zstandard.compress(x.tobytes(), 1)


def restored(raw: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.decompress(raw), kind)


def sorted_bytes(keys: np.ndarray) -> bytes:
    return compressed(np.diff(keys, prepend=np.uint64(0)))


def sorted_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(restored(raw, np.uint64), dtype=np.uint64)


def join_texts(texts: list[bytes], depth: int) -> np.ndarray:
    gap = bytes([END]) * depth
    return _LOWER[np.frombuffer(gap + b"".join(t + gap for t in texts), np.uint8)]


def grams(data: np.ndarray, begin: int, end: int, depth: int) -> np.ndarray:
    """For positions begin to end: the bytes before, last first, and the byte itself."""
    out = data[begin:end].astype(np.uint64)
    for j in range(1, depth + 1):
        out |= data[begin - j : end - j].astype(np.uint64) << np.uint64(8 * (depth + 1 - j))
    return out


class Pack:
    """Bytes of some documents, with what of them is predicted and learned."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, held: np.ndarray, depth: int):
        self.data, self.sizes, self.held, self.depth = data, sizes, held, depth
        self.starts = depth + np.cumsum(sizes + depth) - sizes - depth

    def slices(self, width: int):
        """(grams of predicted positions, document of each) of stretches of bytes."""
        ends = self.starts + self.sizes  # an end symbol each; the others of a gap aren't predicted
        for begin in range(self.depth, len(self.data), width):
            end = min(begin + width, len(self.data))
            low = int(np.searchsorted(ends, begin - self.depth))
            high = int(np.searchsorted(self.starts, end))
            document = np.full(end - begin, -1, np.int64)
            step = np.zeros(end - begin + 1, np.int64)
            opens = self.starts[low:high]
            np.add.at(step, np.maximum(opens, begin) - begin, 1)
            document = np.cumsum(step[:-1]) - 1 + low
            good = document >= low
            good[good] = np.arange(begin, end)[good] <= ends[document[good]]
            yield grams(self.data, begin, end, self.depth)[good], document[good]

    def distinct_grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct grams and how often documents to learn from have them."""
        found = []
        for keys, document in self.slices(1 << 19):
            both = np.sort(keys << np.uint64(1) | (~self.held[document]).astype(np.uint64))
            found.append(counted(both >> np.uint64(1), (both & np.uint64(1)).astype(np.int64)))
            if sum(len(k) for k, _ in found) > 3 << 19:
                found = [_merged(found)]
        return _merged(found)

    def words(self):
        """(hash, document) of all words, by stretches of documents."""
        bounds = np.append(self.starts, len(self.data))
        at = 0
        while at < len(self.sizes):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + (1 << 20), "right")) - 1)
            part = self.data[bounds[at] : bounds[to]]
            starts, ends, first = word_spans(part, bounds[at : to + 1] - bounds[at], _GAP)
            yield span_hashes(part, starts, ends), np.repeat(np.arange(at, to), np.diff(first))
            at = to

    def distinct_words(self) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for keys, document in self.words():
            order = np.argsort(keys)
            found.append(counted(keys[order], (~self.held[document[order]]).astype(np.int64)))
        return _merged(found)


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ones of sorted keys, and sums of their counts."""
    if not len(keys):
        return keys, counts
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def _merged(found) -> tuple[np.ndarray, np.ndarray]:
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, counts = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(keys, kind="stable")
    return counted(keys[order], counts[order])


def ranges(keys: np.ndarray, count: int) -> np.ndarray:
    """The range of each key, by its hash."""
    return ((mix(keys) >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)


def by_range(keys: np.ndarray, count: int):
    """(range, places in ``keys``) in order, for sorted keys."""
    where = ranges(keys, count)
    order = np.argsort(where, kind="stable")
    cuts = np.searchsorted(where[order], np.arange(count + 1))
    for r in range(count):
        if cuts[r] < cuts[r + 1]:
            yield r, order[cuts[r] : cuts[r + 1]]


_PACKS = "pack long, ids array<long>, held array<boolean>, sizes binary, data binary, sample array<array<long>>"


def _pack(depth: int, most: int):
    def run(batches):
        from pyspark import TaskContext

        number, ids, held, texts, size = TaskContext.get().partitionId() << 32, [], [], [], 0

        def made():
            pack = Pack(join_texts(texts, depth), np.array([len(t) for t in texts], np.int64), np.array(held, bool), depth)
            seen = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for out, parts in zip(seen, (pack.slices(1 << 19), pack.words())):
                for keys, _ in parts:
                    out.append(np.unique(keys[mix(keys) & np.uint64((1 << SAMPLE) - 1) == 0]))
            sample = [np.unique(np.concatenate(x)).view(np.int64).tolist() for x in seen]
            row = {"pack": number, "ids": ids, "held": held, "sizes": pack.sizes.tobytes(), "data": compressed(pack.data), "sample": sample}
            return pa.RecordBatch.from_pylist([row], schema=_PACK_SCHEMA)

        for batch in batches:
            for doc, out, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), batch.column("text")):
                text = text.as_py() or b""
                if texts and size + len(text) > most:
                    yield made()
                    number, ids, held, texts, size = number + 1, [], [], [], 0
                ids.append(doc)
                held.append(out)
                texts.append(text)
                size += len(text) + depth
        if texts:
            yield made()

    return run


_PACK_SCHEMA = pa.schema([("pack", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.binary()), ("data", pa.binary()), ("sample", pa.list_(pa.list_(pa.int64())))])
_ROWS = "kind int, r long, pack long, keys binary, vals binary"
_ROW_SCHEMA = pa.schema([("kind", pa.int32()), ("r", pa.int64()), ("pack", pa.int64()), ("keys", pa.binary()), ("vals", pa.binary())])


def _rows(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(list(zip(*rows)) or [[]] * 5, _ROW_SCHEMA)], schema=_ROW_SCHEMA)


def _unpacked(sizes, held, data, depth: int) -> Pack:
    return Pack(restored(data, np.uint8), np.frombuffer(sizes, np.int64), np.array(held, bool), depth)


def _requests(depth: int, counts: tuple[int, int]):
    """Each pack's distinct grams and words by range, with their counts in documents to learn from."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                pack = _unpacked(row["sizes"], row["held"], row["data"], depth)
                release()  # of the pack before
                for kind, (keys, seen) in ((_GRAM, pack.distinct_grams()), (_WORD, pack.distinct_words())):
                    yield _rows([(kind, r, row["pack"], sorted_bytes(keys[at]), compressed(seen[at])) for r, at in by_range(keys, counts[kind])])

    return run


def _groups(batches, *names):
    """Rows of a sorted stream, as (first two columns, generator of the others) for each group of the first two."""
    from itertools import groupby

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(n).to_pylist() for n in names))

    return groupby(rows(), lambda r: r[:2])


def _sum_up(batches):
    """All keys of a range and their counts."""
    for (kind, r), rows in _groups(batches, "kind", "r", "keys", "vals"):
        found = []
        for _, _, keys, vals in rows:
            found.append((sorted_keys(keys), restored(vals, np.int64)))
            if sum(len(k) for k, _ in found) > 4 * RANGE:
                found = [_merged(found)]
        keys, seen = _merged(found)
        yield _rows([(kind, r, -1, sorted_bytes(keys), compressed(seen))])


def _flat(batches):
    for batch in batches:
        for keys, vals in zip(batch.column("keys").to_pylist(), batch.column("vals").to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(sorted_keys(keys).view(np.int64)), pa.array(restored(vals, np.int64))], names=["gram", "n"])


# The tree.


def _log_gamma_half(k: np.ndarray) -> np.ndarray:
    """log Gamma(k + 1/2) of numbers that are counts."""
    x = k + 0.5
    y = x + 8.0  # Stirling's series behind eight steps of the recurrence, exact enough for all x > 0
    product = np.ones_like(x)
    for j in range(8):
        product *= np.where(x < 1e6, x + j, 1.0)
    big = np.where(x < 1e6, y, x)
    series = (big - 0.5) * np.log(big) - big + 0.5 * np.log(2 * np.pi) + 1 / (12 * big) - 1 / (360 * big**3) + 1 / (1260 * big**5)
    return series - 1 / (1680 * big**7) + 1 / (1188 * big**9) - np.log(product)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _log_gamma_half(zeros) + _log_gamma_half(ones) - _log_gamma_half(zeros + ones + 0.5) - _LNPI


class Nodes:
    """Nodes (context, choice) of one depth with their counts, from sorted distinct ``context << 8 | byte``."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        context, byte = keys >> np.uint64(8), keys & np.uint64(255)
        names, zeros, ones = [], [], []
        for bit in range(8):
            name = context << np.uint64(8) | (np.uint64(1 << bit) | byte >> np.uint64(8 - bit))
            one = (byte >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
            first = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
            names.append(name[first])
            zeros.append(np.add.reduceat(np.where(one, 0.0, counts), first))
            ones.append(np.add.reduceat(np.where(one, counts, 0.0), first))
        names, self.zeros, self.ones = (np.concatenate(x) for x in (names, zeros, ones))
        order = np.argsort(names)
        self.names, self.zeros, self.ones = names[order], self.zeros[order], self.ones[order]
        self.estimate = log_kt(self.zeros, self.ones)

    def weigh(self, below: np.ndarray | None) -> None:
        """Pw, and the weight to stop here, given sums of log Pw over the longer contexts."""
        self.weighted = self.estimate if below is None else np.logaddexp(self.estimate, below) - _LN2
        self.stop = np.ones(len(self.names)) if below is None else np.exp(self.estimate - _LN2 - self.weighted)

    def descend(self, rest: np.ndarray, zero: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mixtures so far of each node, itself included, given those of its shorter contexts: weight left, P(0), P(1)."""
        total, share = self.zeros + self.ones + 1, rest * self.stop
        return rest * (1 - self.stop), zero + share * (self.zeros + 0.5) / total, one + share * (self.ones + 0.5) / total


def _shorter(names: np.ndarray, by: int = 1) -> np.ndarray:
    """Names of the nodes whose contexts lack the last ``by`` bytes (the ones farthest back)."""
    return names >> np.uint64(8 * (by + 1)) << np.uint64(8) | names & np.uint64(255)


def levels(keys: np.ndarray, counts: np.ndarray, depth: int, top: int) -> dict[int, Nodes]:
    """Nodes of the depths from ``depth`` up to ``top``, weighted."""
    out, below = {}, None
    for d in range(depth, top - 1, -1):
        out[d] = nodes = Nodes(keys, counts.astype(np.float64))
        if below is not None:
            into = np.searchsorted(nodes.names, _shorter(below.names))
            nodes.weigh(np.bincount(into, below.weighted, len(nodes.names)))
        else:
            nodes.weigh(None)
        below = nodes
        if d > top:
            keys, counts = _regrouped(_shorter(keys), counts)
    return out


def _regrouped(keys, counts):
    order = np.argsort(keys, kind="stable")
    return counted(keys[order], counts[order])


def gram_scores(keys: np.ndarray, tree: dict[int, Nodes], depth: int, top: int, entry) -> np.ndarray:
    """log10 probability of each gram's byte after its context; ``entry(names)``: mixtures above depth ``top``."""
    state = entry(tree[top].names)
    for d in range(top, depth + 1):
        if d > top:
            into = np.searchsorted(tree[d - 1].names, _shorter(tree[d].names))
            state = tuple(x[into] for x in state)
        state = tree[d].descend(*state)
    _, zero, one = state
    context, byte, out = keys >> np.uint64(8), keys & np.uint64(255), np.zeros(len(keys))
    zero, one = np.log10(zero), np.log10(one)
    for bit in range(8):
        into = np.searchsorted(tree[depth].names, context << np.uint64(8) | (np.uint64(1 << bit) | byte >> np.uint64(8 - bit)))
        out += np.where(byte >> np.uint64(7 - bit) & np.uint64(1) > 0, one[into], zero[into])
    return out


def _stretches(batches, shift: int, most: int):
    """Arrays (gram, n) of a stream sorted by gram, cut only where the context of three bytes changes."""
    held, size = [], 0
    for batch in batches:
        gram = np.asarray(batch.column("gram")).view(np.uint64)
        held.append((gram, np.asarray(batch.column("n"))))
        size += len(gram)
        if size >= most:
            gram, n = (np.concatenate(x) for x in zip(*held))
            group = gram >> np.uint64(shift)
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield gram[:cut], n[:cut]
            held, size = [(gram[cut:], n[cut:])], len(gram) - cut
            most = max(most, 2 * size)
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _pairs(depth: int, most: int):
    """For each context of two bytes the sums over the nodes below: (pair, choice, zeros, ones, log Pw below)."""

    def run(batches):
        held = [np.zeros(0, np.uint64), *(np.zeros(0) for _ in range(3))]

        def rows(names, *sums):
            pair, choice = (names >> np.uint64(8)).astype(np.int64), (names & np.uint64(255)).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (pair, choice, *sums)], names=["pair", "choice", "zeros", "ones", "below"])

        for keys, counts in _stretches(batches, 8 * (depth - 2), most):
            deep = levels(keys, counts, depth, 3)[3]
            names = np.concatenate([held[0], _shorter(deep.names)])
            sums = [np.concatenate(x) for x in zip(held[1:], (deep.zeros, deep.ones, deep.weighted))]
            unique, into = np.unique(names, return_inverse=True)
            held = [unique, *(np.bincount(into, x, len(unique)) for x in sums)]
            done = held[0] >> np.uint64(8) < keys[-1] >> np.uint64(8 * (depth - 1))
            if done.any():
                yield rows(*(x[done] for x in held))
                held = [x[~done] for x in held]
        if len(held[0]):
            yield rows(*held)

    return run


def _entries(rows) -> np.ndarray:
    """Mixtures (weight left, P(0), P(1)) below the depths 0 and 1, by last byte and choice, from sums over pairs."""
    out = np.zeros((3, 256, 256))
    out[0] = 1
    if not len(rows):
        return out
    byte, choice = (rows[c].to_numpy(np.int64) for c in ("byte", "choice"))
    zeros, ones, below = (np.zeros((256, 256)) for _ in range(3))
    for table, name in ((zeros, "zeros"), (ones, "ones"), (below, "below")):
        table[byte, choice] = rows[name].to_numpy(float)

    def weigh(zeros, ones, below):
        estimate = log_kt(zeros, ones)
        weighted = np.logaddexp(estimate, below) - _LN2
        return weighted, np.exp(estimate - _LN2 - weighted)

    def mixed(rest, zero, one, zeros, ones, stop):
        return rest * (1 - stop), zero + rest * stop * (zeros + 0.5) / (zeros + ones + 1), one + rest * stop * (ones + 0.5) / (zeros + ones + 1)

    weighted, stop = weigh(zeros, ones, below)
    _, top = weigh(zeros.sum(0), ones.sum(0), weighted.sum(0))
    state = mixed(np.ones(256), np.zeros(256), np.zeros(256), zeros.sum(0), ones.sum(0), top)
    return np.stack(mixed(*(np.broadcast_to(x, (256, 256)) for x in state), zeros, ones, stop))


def _score_grams(depth: int, most: int, entries: np.ndarray, count: int):
    """Log probabilities of grams, as rows of their ranges. The stream holds each pair's nodes before its grams."""

    def run(batches):
        tables: dict[int, list] = {}

        def stream():
            """Grams alone; nodes of pairs are put aside. Both come in pairs' order."""
            for batch in batches:
                node = np.asarray(batch.column("kind")) == 0
                if node.any():
                    part = batch.filter(pa.array(node))
                    arrays = [np.asarray(part.column(c)) for c in ("pair", "choice", "zeros", "ones", "below")]
                    cuts = np.flatnonzero(np.r_[True, arrays[0][1:] != arrays[0][:-1], True])
                    for a, b in zip(cuts, cuts[1:]):
                        tables.setdefault(int(arrays[0][a]), []).append([x[a:b] for x in arrays[1:]])
                if not node.all():
                    yield batch.filter(pa.array(~node))

        def entry(names):
            """Mixtures above depth 3, through the nodes of the pairs."""
            pair, choice = (names >> np.uint64(16)).astype(np.int64), (names & np.uint64(255)).astype(np.int64)
            out = np.zeros((3, len(names)))
            cuts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1], True])
            for a, b in zip(cuts, cuts[1:]):
                choices, zeros, ones, below = (np.concatenate(x) for x in zip(*tables[int(pair[a])]))
                estimate = log_kt(zeros, ones)
                stop = np.exp(estimate - _LN2 - (np.logaddexp(estimate, below) - _LN2))
                rest, zero, one = entries[:, pair[a] >> 8, :][:, choices]
                place = np.zeros(256, np.int64)
                place[choices] = np.arange(len(choices))
                mixed = (rest * (1 - stop), zero + rest * stop * (zeros + 0.5) / (zeros + ones + 1), one + rest * stop * (ones + 0.5) / (zeros + ones + 1))
                out[:, a:b] = np.stack(mixed)[:, place[choice[a:b]]]
            return tuple(out)

        for keys, counts in _stretches(stream(), 8 * (depth - 2), most):
            scores = gram_scores(keys, levels(keys, counts, depth, 3), depth, 3, entry).astype(np.float32)
            yield _rows([(_GRAM, r, -1, sorted_bytes(keys[at]), compressed(scores[at])) for r, at in by_range(keys, count)])
            last = int(keys[-1] >> np.uint64(8 * (depth - 1)))
            for pair in [p for p in tables if p < last]:
                del tables[pair]

    return run


# Answers.


def _answer(batches):
    """Values of each pack's keys, from the range's table that comes before them."""
    kinds = {_GRAM: np.float32, _WORD: np.int64}
    for (kind, r), rows in _groups(batches, "kind", "r", "pack", "keys", "vals"):
        found, table = [], None
        for _, _, pack, keys, vals in rows:
            if pack < 0:
                found.append((sorted_keys(keys), restored(vals, kinds[kind])))
                continue
            if table is None:
                table, values = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(table)
                table, values = table[order], values[order]
            yield _rows([(kind, r, pack, b"", compressed(values[np.searchsorted(table, sorted_keys(keys))]))])


def _scorer(depth: int, counts: tuple[int, int], tokens: int, distinct: int, ends: int):
    floor = np.log10(tokens + 0.1 * (distinct + 1))

    def run(batches):
        answers: dict[int, list] = {_GRAM: [], _WORD: []}
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] != _DATA:
                    answers[row["kind"]].append(row["vals"])
                    continue
                pack = _unpacked(row["sizes"], row["held"], row["data"], depth)
                n, values = len(pack.sizes), {}
                for kind, (keys, _) in ((_GRAM, pack.distinct_grams()), (_WORD, pack.distinct_words())):
                    order = np.concatenate([np.zeros(0, np.int64), *(at for _, at in by_range(keys, counts[kind]))])
                    got = np.concatenate([np.zeros(0), *(restored(x, np.float32 if kind == _GRAM else np.int64) for x in answers[kind])])
                    values[kind] = keys, np.empty(len(keys))
                    values[kind][1][order] = got  # as many as keys, or numpy raises
                score = np.zeros(n)
                for keys, document in pack.slices(SLICE):
                    order = np.argsort(keys)
                    distinct_, again = np.unique(keys[order], return_inverse=True)
                    found = values[_GRAM][1][np.searchsorted(values[_GRAM][0], distinct_)][again]
                    if len(document):
                        low = document[0]
                        sums = np.bincount(document[order] - low, found)
                        score[low : low + len(sums)] += sums
                n_tokens, known = np.ones(n, np.int64), np.full(n, int(ends > 0), np.int64)
                base = np.full(n, np.log10(ends + 0.1) - floor)
                for keys, document in pack.words():
                    c = values[_WORD][1][np.searchsorted(values[_WORD][0], keys)]
                    n_tokens += np.bincount(document, minlength=n)
                    known += np.bincount(document, c > 0, n).astype(np.int64)
                    base += np.bincount(document, np.log10(c + 0.1) - floor, n)
                columns = [pa.array(row["ids"], pa.int64()), pa.array(row["held"], pa.bool_()), *map(pa.array, (n_tokens, known, np.full(n, tokens), base, score, pack.sizes))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"])
                answers = {_GRAM: [], _WORD: []}
                release()

    return run


def score(documents: DataFrame, modulus: int = 10, remainder: int = 0, depth: int = DEPTH, pack: int = PACK, most: int = RANGE) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes)`` of every row.

    Learns from rows that aren't held out. ``score`` is the log10 probability of the whole text, so a text's code length
    is -score / log10(2) bits for n_bytes bytes. ``depth``: bytes of context, 3 to 5; ``most``: keys that a task holds.
    """
    if not 3 <= depth <= 5:
        raise ValueError("a context has 3 to 5 bytes")
    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), holds_out("doc_id", modulus, remainder).alias("held_out"), F.col("text").cast("string").cast("binary").alias("text"))
    packs = durable(rows.mapInArrow(_pack(depth, pack), _PACKS), "lm-packs")
    sampled = packs.select(F.posexplode("sample").alias("kind", "keys")).select("kind", F.explode("keys").alias("key"))
    estimates = {kind: n << SAMPLE for kind, n in sampled.distinct().groupBy("kind").count().collect()}
    counts = tuple(1 + estimates.get(kind, 0) // most for kind in (_GRAM, _WORD))
    requests = durable(packs.select("pack", "sizes", "held", "data").mapInArrow(_requests(depth, counts), _ROWS), "lm-requests")
    dealt = requests.select("kind", "r", "keys", "vals").repartition("kind", "r").sortWithinPartitions("kind", "r")
    totals = durable(dealt.mapInArrow(_sum_up, _ROWS), "lm-counts")

    # How many words documents to learn from have, and how many different ones; an end counts as a word.
    tally = totals.where(F.col("kind") == _WORD).mapInArrow(_tally, "tokens long, words long").agg(F.sum("tokens"), F.sum("words")).first()
    ends = packs.select(F.sum(F.size(F.filter("held", lambda x: ~x)))).first()[0] or 0
    tokens, distinct = (tally[0] or 0) + ends, (tally[1] or 0) + (ends > 0)

    pair = F.shiftrightunsigned("gram", 8 * (depth - 1))
    flat = totals.where(F.col("kind") == _GRAM).mapInArrow(_flat, "gram long, n long").withColumn("pair", pair)
    flat = durable(flat, "lm-grams")
    streams = flat.repartition("pair").sortWithinPartitions("pair", "gram").select("gram", "n")
    pairs = durable(streams.mapInArrow(_pairs(depth, most), "pair long, choice int, zeros double, ones double, below double"), "lm-pairs")
    entries = _entries(_weighted(pairs).toPandas())  # a row for each last byte and choice

    both = flat.select("pair", F.lit(1).alias("kind"), "gram", "n", F.lit(0).alias("choice"), *(F.lit(0.0).alias(c) for c in ("zeros", "ones", "below")))
    both = both.unionByName(pairs.select("pair", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("gram"), F.lit(0).cast("long").alias("n"), "choice", "zeros", "ones", "below"))
    both = both.repartition("pair").sortWithinPartitions("pair", "kind", "gram")
    model = both.mapInArrow(_score_grams(depth, most, entries, counts[_GRAM]), _ROWS)

    tables = model.union(totals.where(F.col("kind") == _WORD)).union(requests.select("kind", "r", "pack", "keys", F.lit(None).cast("binary").alias("vals")))
    answers = tables.repartition("kind", "r").sortWithinPartitions("kind", "r", "pack").mapInArrow(_answer, _ROWS)
    nothing = {"sizes": "binary", "data": "binary", "ids": "array<long>", "held": "array<boolean>"}
    answers = answers.select("pack", "kind", "r", "vals", *(F.lit(None).cast(t).alias(c) for c, t in nothing.items()))
    data = packs.select("pack", F.lit(_DATA).alias("kind"), F.lit(0).cast("long").alias("r"), F.lit(None).cast("binary").alias("vals"), *nothing)
    last = answers.union(data).repartition("pack").sortWithinPartitions("pack", "kind", "r")
    return last.mapInArrow(_scorer(depth, counts, tokens, distinct, ends), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long")


def _tally(batches):
    for batch in batches:
        seen = [restored(v, np.int64) for v in batch.column("vals").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([int(x.sum()) for x in seen], pa.int64()), pa.array([int((x > 0).sum()) for x in seen], pa.int64())], names=["tokens", "words"])


def _weighted(pairs: DataFrame) -> DataFrame:
    """Sums over pairs of one last byte: zeros, ones and log Pw of the pairs' nodes."""

    def run(batches):
        for batch in batches:
            zeros, ones, below = (np.asarray(batch.column(c)) for c in ("zeros", "ones", "below"))
            weighted = np.logaddexp(log_kt(zeros, ones), below) - _LN2
            byte = np.asarray(batch.column("pair")) >> 8
            yield pa.RecordBatch.from_arrays([pa.array(byte), batch.column("choice"), *map(pa.array, (zeros, ones, weighted))], names=["byte", "choice", "zeros", "ones", "below"])

    rows = pairs.mapInArrow(run, "byte long, choice int, zeros double, ones double, below double")
    return rows.groupBy("byte", "choice").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "below")))
