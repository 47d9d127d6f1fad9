"""Language identification with a linear-chain conditional random field over words.

Every word of a text gets one of the learned languages as its hidden label. Affixes, byte n-grams and lexicon
membership make the emission scores, learned transitions tie neighbouring words, and forward-backward gives each
word's marginals, so code-switched texts are labelled word by word. A document's language is that of the largest share
of marginal mass. Marginals sum to 1 over the learned languages, so they can't tell that a text is in none of them; for
that, a word is *typical* of a language if its byte n-grams have a mean log-probability there that is reached by all
but ``ATYPICAL`` of that language's words in texts the probabilities weren't taken from. A document's score is its
language's share of marginal mass over typical words only, out of all words: the share of words that are in it.

Training takes at most ``PER_LANGUAGE`` documents a language (``SAMPLE`` in all, least key hash first) that aren't held
out, and about ``WORDS`` words from places spread over each, the first ``WORD_BYTES`` bytes of a word; they are spliced into sequences that switch language now and
then, so the transitions are learned from switches too. Prediction reads every word; a text of more than ``CHAIN`` words
is decoded in pieces that move side by side, and each piece begins and ends with the exact messages of its neighbours,
so the marginals are those of the uncut chain.

A word is a run of letters (ASCII letters and bytes from 0x80), lower-cased. Null text or text without a letter:
``und`` with score 0. Of equally likely languages the alphabetically first counts. Null doc_ids and repeated rows keep
their rows; without anything to learn from, all is ``und``; an empty table gives an empty result. Other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import filter_batches, holds_out, release, ship
from .shingles import lowered, mix, slices, span_hashes, utf8_buffers, word_spans

PER_LANGUAGE, SAMPLE, WORDS, WORD_BYTES, CHAIN = 400, 20000, 300, 48, 1024
BITS, LEXICON, SEGMENT, SEQUENCE, ROUNDS = 16, 20000, 15, 60, 40
ATYPICAL = 0.02
_LETTERS = np.ones(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_MASK = np.uint64((1 << BITS) - 1)


class Words:
    """The distinct words of some bytes with their features, all as flat arrays."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lexicon: np.ndarray):
        hashes = span_hashes(raw, starts, ends)
        self.hashes, at, self.of = np.unique(hashes, return_index=True, return_inverse=True)
        s, e = starts[at], ends[at]
        self.count = len(s)
        size = e - s
        begin = np.r_[0, np.cumsum(size + 2)]
        self.owner = np.repeat(np.arange(self.count), size + 2)
        flat = np.zeros(int(begin[-1]), np.uint64)
        inner = np.ones(len(flat), bool)
        inner[begin[:-1]] = inner[begin[1:] - 1] = False
        flat[begin[:-1]], flat[begin[1:] - 1] = 1, 2
        flat[inner] = raw[np.repeat(s - np.r_[0, np.cumsum(size)][:-1], size) + np.arange(int(size.sum()))]
        two = flat[:-1] << np.uint64(8) | flat[1:] if len(flat) else flat
        # Bigrams at every place but a word's last, trigrams at every place but its last two.
        here = np.ones(len(flat), bool)
        here[begin[1:] - 1] = False
        bi = np.flatnonzero(here)
        here[begin[1:] - 2] = False
        tri = np.flatnonzero(here)
        self.gram_owner = np.r_[self.owner[bi], self.owner[tri]]
        self.grams = np.r_[two[bi] & _MASK, mix(two[tri] << np.uint64(8) | flat[tri + 2]) & _MASK].astype(np.int64)
        self.gram_count = np.maximum(np.bincount(self.gram_owner, minlength=self.count), 1)
        affixes = []
        head, tail = np.zeros(self.count, np.uint64), np.zeros(self.count, np.uint64)
        for k in range(1, 5):
            there = size >= k
            head = np.where(there, head << np.uint64(8) | flat[np.minimum(begin[:-1] + k, len(flat) - 1)] if self.count else head, head)
            tail = np.where(there, tail | flat[np.maximum(begin[1:] - 1 - k, 0)] << np.uint64(8 * (k - 1)) if self.count else tail, tail)
            affixes += [mix(head * np.uint64(16) + np.uint64(k)), mix(tail * np.uint64(16) + np.uint64(k + 8))]
        self.affixes = (np.stack(affixes) & _MASK).astype(np.int64)
        place = np.minimum(np.searchsorted(lexicon, self.hashes), max(len(lexicon) - 1, 0))
        self.lexeme = np.where(lexicon[place] == self.hashes, place, len(lexicon)) if len(lexicon) else np.zeros(self.count, np.int64)

    def emissions(self, gram_w: np.ndarray, affix_w: np.ndarray, lexeme_w: np.ndarray) -> np.ndarray:
        out = lexeme_w[self.lexeme].astype(np.float64)
        for a in self.affixes:
            out += affix_w[a]
        for k in range(out.shape[1]):
            out[:, k] += np.bincount(self.gram_owner, gram_w[self.grams, k], self.count) / self.gram_count
        return out


def gram_scores(words: Words, of: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Log-probability of every n-gram in each language, from word occurrences ``of`` with labels ``y``."""
    out = np.zeros((1 << BITS, n))
    for k in range(n):
        out[:, k] = np.bincount(words.grams, np.bincount(of[y == k], minlength=words.count)[words.gram_owner], 1 << BITS)
    return np.log((out + 0.1) / (out + 0.1).sum(0)).astype(np.float32)


def word_scores(words: Words, grams: np.ndarray) -> np.ndarray:
    """Mean log-probability of each distinct word's n-grams in each language."""
    return np.stack([np.bincount(words.gram_owner, grams[words.grams, k], words.count) / words.gram_count for k in range(grams.shape[1])], 1)


def typical_words(words: Words, document: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """N-gram scores of the languages and the least score of a typical word, from documents the other half has scored."""
    odd, own = document % 2 == 1, np.zeros(len(y))
    for half in (odd, ~odd):
        scores = word_scores(words, gram_scores(words, words.of[half], y[half], n))
        own[~half] = scores[words.of[~half], y[~half]]
    least = np.array([np.quantile(own[y == k], ATYPICAL) if (y == k).any() else 0.0 for k in range(n)])
    return gram_scores(words, words.of, y, n), least


def forward_backward(emissions: np.ndarray, transitions: np.ndarray, first: np.ndarray, length: np.ndarray, pairs: bool = False, before: np.ndarray | None = None, after: np.ndarray | None = None):
    """Marginals of every position (sequences lie at first[i] .. first[i] + length[i]); all sequences move together.

    With ``pairs`` also the expected transition counts. ``before`` and ``after``: for each sequence the message into its
    first position and out of what follows its last one, where it is part of a longer chain.
    """
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    before, after = (None if x is None else x[order].astype(np.float32) for x in (before, after))
    top = emissions.max(1, keepdims=True) if len(emissions) else emissions
    e, move = np.exp(emissions - top).astype(np.float32), np.exp(transitions).astype(np.float32)
    longest = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(longest), "left")
    alpha, scale = np.zeros_like(e), np.zeros(len(e), np.float32)
    state = None
    for t in range(longest):
        k = alive[t]
        at = first[:k] + t
        state = (e[at] if before is None else before * e[at]) if state is None else (state[:k] @ move) * e[at]
        total = state.sum(1)
        state = state / total[:, None]
        alpha[at], scale[at] = state, total
    expected, state = np.zeros_like(transitions), None
    for t in range(longest - 1, -1, -1):
        k = alive[t]
        at = first[:k] + t
        grown = np.ones((k, e.shape[1]), np.float32) if after is None else after[:k].copy()
        if state is not None:
            later = (first[: len(state)] + t + 1)
            message = state * e[later]
            if pairs:
                joint = alpha[at[: len(state)]][:, :, None] * move[None] * message[:, None, :]
                expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            message = message @ move.T
            grown[: len(state)] = message / message.sum(1, keepdims=True)
        state = grown
        marginal = alpha[at] * state
        alpha[at] = marginal / marginal.sum(1, keepdims=True)
    return (alpha, expected) if pairs else alpha


def chains(emissions: np.ndarray, transitions: np.ndarray, first: np.ndarray, length: np.ndarray, chain: int = CHAIN) -> np.ndarray:
    """Marginals of every position, as ``forward_backward`` gives them, with long sequences cut into pieces of ``chain``.

    A piece's transfer matrix tells how it passes on any message; from these, each piece's messages at both ends follow.
    """
    pieces = -(-length // chain)
    owner = np.repeat(np.arange(len(length)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin, size = first[owner] + nth * chain, np.minimum(length[owner] - nth * chain, chain)
    if not len(owner) or pieces.max() == 1:
        return forward_backward(emissions, transitions, begin, size)
    n = emissions.shape[1]
    before, after = np.ones((len(owner), n)), np.ones((len(owner), n))
    move = np.exp(transitions)
    cut = np.flatnonzero(pieces[owner] > 1)
    order = cut[np.argsort(-size[cut], kind="stable")]
    alive = np.searchsorted(-size[order], -np.arange(size[order[0]]), "left")
    transfer = np.zeros((len(owner), n, n))
    state = np.repeat(np.eye(n)[None], len(order), 0)
    for t, k in enumerate(alive):
        e = emissions[begin[order[:k]] + t]
        state = (state[:k] if t == 0 else state[:k] @ move) * np.exp(e - e.max(1, keepdims=True))[:, None, :]
        state /= state.sum((1, 2), keepdims=True)
        transfer[order[:k]] = state
    for i in np.flatnonzero(nth == 0):
        last = i + pieces[owner[i]] - 1
        for p in range(i, last):
            message = before[p] @ transfer[p] @ move
            before[p + 1] = message / message.sum()
        for p in range(last, i, -1):
            message = move @ (transfer[p] @ after[p])
            after[p - 1] = message / message.sum()
    return forward_backward(emissions, transitions, begin, size, before=before, after=after)


def train(texts: list[bytes], languages: list[str], seed: int = 7) -> dict:
    """A model from texts of one language each."""
    names = sorted(set(languages))
    if not names:
        return {"names": []}
    label = {x: k for k, x in enumerate(names)}
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    offsets[-1] = len(raw)
    raw = lowered(raw)
    starts, ends, first = word_spans(raw, offsets, _LETTERS)
    hashes, counts = np.unique(span_hashes(raw, starts, ends), return_counts=True)
    often = counts >= 4
    hashes, counts = hashes[often], counts[often]
    lexicon = np.sort(hashes[np.argsort(-counts, kind="stable")[:LEXICON]])
    words = Words(raw, starts, ends, lexicon)
    # Splice segments of the documents into sequences; most segments continue in the same language.
    rng = np.random.default_rng(seed)
    segments: list[list[np.ndarray]] = [[] for _ in names]
    for d, language in enumerate(languages):
        own = words.of[first[d] : first[d + 1]]
        segments[label[language]] += [own[i : i + SEGMENT] for i in range(0, len(own), SEGMENT)]
    heads = [rng.permutation(len(s)) for s in segments]
    queue = [list(h) for h in heads]
    sequence_words, sequence_labels, lengths = [], [], []
    while any(queue):
        open_ = [k for k, q in enumerate(queue) if q]
        k, size = int(rng.choice(open_)), 0
        while size < SEQUENCE:
            if not queue[k]:
                break
            piece = segments[k][queue[k].pop()]
            sequence_words.append(piece)
            sequence_labels.append(np.full(len(piece), k))
            size += len(piece)
            if rng.random() < 0.2:
                k = int(rng.integers(len(names)))
        lengths.append(size)
    if not sequence_words or not sum(lengths):
        return {"names": []}
    word, y, length = np.concatenate(sequence_words), np.concatenate(sequence_labels), np.array([x for x in lengths if x])
    begin = np.r_[0, np.cumsum(length)][:-1]
    n = len(names)
    inside = np.ones(len(y), bool)
    inside[begin] = False
    at = np.flatnonzero(inside)
    seen = np.bincount(y[at - 1] * n + y[at], minlength=n * n).reshape(n, n)
    parameters = [np.zeros((1 << BITS, n)), np.zeros((1 << BITS, n)), np.zeros((len(lexicon) + 1, n)), np.zeros((n, n))]
    first_m, second_m = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for t in range(1, ROUNDS + 1):
        emission = words.emissions(*parameters[:3])
        marginal, expected = forward_backward(emission[word], parameters[3], begin, length, True)
        by_word = np.stack([np.bincount(word, marginal[:, k] - (y == k), words.count) for k in range(n)], 1)
        grads = [np.zeros_like(p) for p in parameters]
        spread = by_word / words.gram_count[:, None]
        for k in range(n):
            grads[0][:, k] = np.bincount(words.grams, spread[words.gram_owner, k], 1 << BITS)
            grads[1][:, k] = sum(np.bincount(a, by_word[:, k], 1 << BITS) for a in words.affixes)
            grads[2][:, k] = np.bincount(words.lexeme, by_word[:, k], len(lexicon) + 1)
        grads[3] = expected - seen
        for p, g, m, v in zip(parameters, grads, first_m, second_m):
            g = (g + 0.5 * p) / len(y)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    document = np.repeat(np.arange(len(texts)), np.diff(first))
    typical = typical_words(words, document, np.array([label[x] for x in languages])[document], n)
    return {"names": names, "lexicon": lexicon, "parameters": [p.astype(np.float32) for p in parameters], "typical": typical}


def fit(documents: DataFrame, modulus: int = 5, remainder: int = 0) -> dict:
    """Learn from ``documents(doc_id, text, lang)``; only the sample's words come to the driver, not what lies between."""
    ship(documents.sparkSession)
    keys = documents.select(F.col("doc_id").cast("long").alias("key"), F.col("lang").cast("string").alias("language"), F.col("text").cast("string").alias("text")).where("key is not null and language is not null and text is not null")
    # A repeated key counts once, with one of its languages and texts.
    keys = keys.where(~holds_out("key", modulus, remainder)).groupBy("key").agg(F.min(F.struct("language", F.xxhash64("text").alias("text_key"))).alias("row")).select("key", "row.*")
    # First the least keys of each of 64 parts of a language, then of the language: no task sees all of a frequent one.
    place = [F.xxhash64("key"), F.col("key")]
    parts = keys.withColumn("part", F.pmod(F.xxhash64("key", F.lit(7)), F.lit(64)))
    some_of = parts.withColumn("k", F.row_number().over(Window.partitionBy("language", "part").orderBy(*place))).where(F.col("k") <= PER_LANGUAGE)
    chosen = some_of.withColumn("k", F.row_number().over(Window.partitionBy("language").orderBy(*place))).where(F.col("k") <= PER_LANGUAGE)
    chosen = chosen.select("key", "language", "text_key").orderBy(F.xxhash64("key")).limit(SAMPLE)

    def some(batches):
        for batch in batches:
            raw, offsets = utf8_buffers(batch.column("text"))
            out = []
            for _, _, part, cut in slices(raw, offsets):
                starts, ends, first = word_spans(part, cut, _LETTERS)
                for i, j in zip(first[:-1], first[1:]):
                    step = max(1, (j - i) * 20 // WORDS)  # pieces of 20 words from evenly spread places
                    places = [w for k in range(i, j, max(step, 20)) for w in range(k, min(k + 20, j))]
                    out.append(b" ".join(part[starts[w] : min(ends[w], starts[w] + WORD_BYTES)].tobytes() for w in places))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.binary()), batch.column("language")], names=["key", "text", "language"])

    texts = documents.select(F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    got = texts.join(F.broadcast(chosen), ["key", "text_key"]).select("key", "text", "language").mapInArrow(some, "key long, text binary, language string")
    got = got.groupBy("key").agg(F.min("text").alias("text"), F.first("language").alias("language")).select("text", "language").toPandas()
    got = got.sort_values(["language", "text"])
    model = train(list(got["text"]), list(got["language"]))
    del got
    release()
    return model


def _marginals(model: dict, column: pa.Array):
    """For each slice: (marginals of all words, whether they are typical, document bounds in words, word begins and ends, its bytes and offsets)."""
    raw, offsets = utf8_buffers(column)
    for _, _, part, cut in slices(raw, offsets):
        low = lowered(part)
        starts, ends, first = word_spans(low, cut, _LETTERS)
        if not len(starts):
            none = np.zeros((0, len(model["names"])))
            yield none, none, first, starts, ends, part, cut
            continue
        words = Words(low, starts, ends, model["lexicon"])
        emission = words.emissions(*model["parameters"][:3])[words.of]
        grams, least = model["typical"]
        typical = (word_scores(words, grams) >= least)[words.of]
        yield chains(emission, model["parameters"][3], first[:-1], np.diff(first)), typical, first, starts, ends, part, cut


def _has_letter(part: np.ndarray, cut: np.ndarray) -> np.ndarray:
    ascii_ = np.r_[0, np.cumsum(((part | 32) >= 97) & ((part | 32) <= 122))]
    out = ascii_[cut[1:]] > ascii_[cut[:-1]]
    for k in np.flatnonzero(~out & (np.diff(cut) > 0)):
        out[k] = any(c.isalpha() for c in part[cut[k] : cut[k + 1]].tobytes().decode("utf-8", "replace"))
    return out


def languages_of(column: pa.Array, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """(language number, score) of each text; the number after the last language means none."""
    none = len(model["names"])
    predicted, scores = [np.zeros(0, int)], [np.zeros(0)]
    if not none:
        return np.zeros(len(column), int), np.zeros(len(column))
    for marginal, typical, first, _, _, part, cut in _marginals(model, column):
        total, sure = (np.r_[np.zeros((1, x.shape[1])), np.cumsum(x, 0, dtype=np.float64)] for x in (marginal, marginal * typical))
        share, sure = ((x[first[1:]] - x[first[:-1]]) / np.maximum(np.diff(first), 1)[:, None] for x in (total, sure))
        best, known = share.argmax(1), _has_letter(part, cut)
        predicted.append(np.where(known, best, none))
        scores.append(np.where(known, np.clip(sure[np.arange(len(best)), best], 0, 1), 0.0))
    return np.concatenate(predicted), np.concatenate(scores)


def predict(documents: DataFrame, model: dict, modulus: int = 5, remainder: int = 0) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row."""
    names = np.array([*model["names"], "und"], object)

    def run(batches):
        for batch in batches:
            predicted, scores = languages_of(batch.column("text"), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names[predicted], pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("held_out", holds_out("doc_id", modulus, remainder))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep(documents: DataFrame, model: dict, least: float) -> DataFrame:
    """The rows, with all their columns, whose text has a language of at least this share of its words."""

    def mask(batch):
        predicted, scores = languages_of(batch.column("text"), model)
        return (predicted < len(model["names"])) & (scores >= least)

    return filter_batches(documents, mask)


def tag(documents: DataFrame, model: dict) -> DataFrame:
    """``(doc_id, begin, end, lang, probability)``: byte spans of neighbouring words of the same most likely language."""
    names = np.array(model["names"], object)

    def run(batches):
        for batch in batches:
            ids, out, at = batch.column("doc_id").to_pylist(), [], 0
            for marginal, _, first, starts, ends, _, cut in _marginals(model, batch.column("text")) if len(names) else ():
                best = marginal.argmax(1)
                for d in range(len(first) - 1):
                    i, j = first[d], first[d + 1]
                    turn = i + np.flatnonzero(np.r_[True, best[i + 1 : j] != best[i : j - 1]]) if j > i else []
                    for a, b in zip(turn, [*turn[1:], j]):
                        out.append((ids[at + d], int(starts[a] - cut[d]), int(ends[b - 1] - cut[d]), names[best[a]], float(marginal[a:b, best[a]].mean())))
                at += len(first) - 1
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64()))], names=["doc_id", "begin", "end", "lang", "probability"])

    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, begin long, end long, lang string, probability double")
