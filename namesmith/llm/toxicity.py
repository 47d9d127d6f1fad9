"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a logistic score over its hashed words and their stems (heads of
4, 5 and 6 bytes, so that inflected forms share evidence), and the document's score is their noisy-or, 1 - prod(1 - p). Only documents carry labels; the gradient of the noisy-or decides which
sentences answer for a toxic document, so the trained model also locates the offending sentences.

Training uses at most ``SAMPLE`` labelled rows that aren't held out (uniform by key hash) and ``FIT_FEATURES`` features
(words and heads) of a row, those of whole sentences from all over its text: bounds independent of the corpus and of its
texts' lengths. Words of fewer than ``LEAST_DOCUMENTS`` sampled documents have weight 0. Scoring is one pass over whole texts:
every word of a text of any length counts.

Null, empty and wordless texts score 0. Null doc_ids and repeated rows keep their rows. Without usable labels every
score is 0. An empty table gives an empty result. Equal texts score alike, and a score of exactly ``THRESHOLD`` counts as
toxic. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import labelled_texts, sigmoid
from .runtime import filter_batches, holds_out, release, ship
from .shingles import lowered, mix, slices, span_hashes, utf8_buffers, word_spans

SAMPLE, LEAST_DOCUMENTS, BITS, ROUNDS, HEADS = 5000, 4, 18, 120, (4, 5, 6)
FIT_FEATURES = 6000
RIDGE, LASSO, THRESHOLD, RATE, START = 0.05, 1.0, 0.3, 0.1, 0.7
_NOT_WORD = np.ones(256, bool)
_NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_STOP = np.zeros(256, bool)
_STOP[[10, 33, 46, 63]] = True


def bags(column: pa.Array):
    """For each slice of rows: (features of its words, sentence of each word, document of each sentence, rows, sentence bounds, raw)."""
    raw, offsets = utf8_buffers(column)
    for begin, end, part, cut in slices(raw, offsets):
        starts, ends, first = word_spans(part, cut, _NOT_WORD)
        forms = word_forms(lowered(part), starts, ends)
        document = np.repeat(np.arange(end - begin), np.diff(first))
        stops = np.cumsum(_STOP[part]) if len(part) else np.zeros(0, np.int64)
        key = stops[starts] if len(starts) else np.zeros(0, np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (document[1:] != document[:-1]) | (key[1:] != key[:-1])
        sentence = np.cumsum(new) - 1
        opening = np.flatnonzero(new)
        closing = np.r_[opening[1:], len(starts)] - 1 if len(opening) else opening
        features, sentence = forms.T.ravel(), np.repeat(sentence, len(forms))
        features, sentence = features[features >= 0], sentence[features >= 0]
        yield features, sentence, document[opening], end - begin, (starts[opening] - cut[document[opening]], ends[closing] - cut[document[opening]], part, cut)


def word_forms(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Feature numbers of each word and its heads, -1 where a word is no longer than a head."""
    out = np.full((1 + len(HEADS), len(starts)), -1, np.int32)
    if len(starts):
        out[0] = span_hashes(raw, starts, ends) >> np.uint64(64 - BITS)
        for k, head in enumerate(HEADS, 1):
            long = ends - starts > head
            out[k, long] = span_hashes(raw, starts[long], starts[long] + head) >> np.uint64(64 - BITS)
    return out


def bounded(features: np.ndarray, sentence: np.ndarray, document: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bags with at most ``limit`` features a document: sentences in the order of a hash of their number while they fit.

    Where the first of them doesn't, it gives features from evenly spread places. Shorter documents stay whole.
    """
    of = document[sentence]
    keep = np.ones(len(features), bool)
    for d in np.flatnonzero(np.bincount(of) > limit):
        lo, hi = np.searchsorted(of, (d, d + 1))
        begin = np.flatnonzero(np.r_[True, sentence[lo + 1 : hi] != sentence[lo : hi - 1]])
        size = np.diff(np.r_[begin, hi - lo])
        order = np.argsort(mix(np.arange(len(size), dtype=np.uint64)), kind="stable")
        fits = np.zeros(len(size), bool)
        fits[order[np.cumsum(size[order]) <= limit]] = True
        keep[lo:hi] = np.repeat(fits, size)
        if not fits.any():
            first = order[0]
            keep[lo + begin[first] + np.arange(limit) * size[first] // limit] = True
    kept, sentence = np.unique(sentence[keep], return_inverse=True)
    return features[keep], sentence, document[kept]


def sentence_logits(features, sentence, count: int, weights, bias: float) -> np.ndarray:
    return bias + np.bincount(sentence, weights[features], count) if count else np.zeros(0)


def noisy_or(logits: np.ndarray, document: np.ndarray, count: int) -> np.ndarray:
    return -np.expm1(-np.bincount(document, np.logaddexp(0, logits), count)) if count else np.zeros(0)


def train(parts, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and bias that fit document labels through the noisy-or, by Adam over all bags.

    ``parts``: (features, sentence of each, document of each sentence, labels) of some documents each.
    """
    size = 1 << BITS
    weights, bias = np.zeros(size, np.float32), -6.0
    seen, seen_bad, bad = np.zeros(size, np.int64), np.zeros(size, np.int64), 0
    for f, s, d, y in parts:
        pairs = np.unique(d[s].astype(np.int64) << BITS | f)
        seen += np.bincount(pairs & (size - 1), minlength=size)
        seen_bad += np.bincount(pairs[y[pairs >> BITS] > 0] & (size - 1), minlength=size)
        bad += int((y > 0).sum())
    known = seen >= LEAST_DOCUMENTS
    used = np.flatnonzero(known)
    number = np.cumsum(known, dtype=np.int32) - 1
    # Parts stay apart, so that a step's temporary arrays are those of a part.
    bags_, sentences, count = [], 0, 0
    documents, labels = [np.zeros(0, np.int32)], [np.zeros(0, np.int8)]
    for f, s, d, y in parts:
        keep = known[f]
        bags_.append((number[f[keep]], s[keep], slice(sentences, sentences + len(d))))
        documents.append(d + np.int32(count))
        labels.append(y)
        sentences, count = sentences + len(d), count + len(y)
    document, y = np.concatenate(documents), np.concatenate(labels)
    if not count or y.min() == y.max():
        return weights, -50.0
    w, m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    # Start from the shrunk log-odds of documents with each feature: all-documents steps alone are slow to find them.
    w[:-1] = START * np.maximum(np.log((seen_bad[used] + 0.5) / bad * (count - bad) / (seen[used] - seen_bad[used] + 0.5)) - 1, 0)
    w[-1] = bias
    for t in range(1, rounds + 1):
        z = np.full(sentences, w[-1])
        for features, sentence, own in bags_:
            z[own] += np.bincount(sentence, w[features], own.stop - own.start)
        s = np.maximum(np.bincount(document, np.logaddexp(0, z), count), 1e-9)
        ds = np.where(y > 0, -1 / np.expm1(np.minimum(s, 500)), 1.0)
        dz = ds[document] * sigmoid(z)
        slope = np.zeros(len(used))
        for features, sentence, own in bags_:
            slope += np.bincount(features, dz[own][sentence], len(used))
        g = np.r_[slope + RIDGE * w[:-1] + LASSO * np.tanh(20 * w[:-1]), dz.sum()] / count
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= RATE * (1 - t / (rounds + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
    weights[used] = w[:-1]
    return weights, float(w[-1])


def fit(documents: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, label: str = "toxic", limit: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Model from a bounded labelled sample; at most ``FIT_FEATURES`` feature numbers a row come to the driver, texts don't."""

    def pack(batches):
        for batch in batches:
            y = batch.column("y").to_pylist()
            at = 0
            for features, sentence, document, rows, _ in bags(batch.column("text")):
                features, sentence, document = bounded(features, sentence, document, FIT_FEATURES)
                yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in ((features.tobytes(), pa.binary()), (sentence.astype(np.int32).tobytes(), pa.binary()), (document.astype(np.int32).tobytes(), pa.binary()), (np.array(y[at : at + rows], np.int8).tobytes(), pa.binary()))], names=["f", "s", "d", "y"])
                at += rows

    ship(documents.sparkSession)
    got = labelled_texts(documents, labels, label, modulus, remainder, limit).mapInArrow(pack, "f binary, s binary, d binary, y binary").toPandas()
    kinds = (np.int32, np.int32, np.int32, np.int8)
    model = train([tuple(np.frombuffer(x, kind) for x, kind in zip(row, kinds)) for row in got.itertuples(index=False)])
    del got
    release()
    return model


def scores_of(column: pa.Array, model: tuple[np.ndarray, float]) -> np.ndarray:
    """The score of each text of a string column."""
    scores = [np.zeros(0)]
    for features, sentence, document, rows, _ in bags(column):
        scores.append(noisy_or(sentence_logits(features, sentence, len(document), *model), document, rows))
    return np.clip(np.concatenate(scores), 0, 1)


def _scorer(model: tuple[np.ndarray, float]):
    def run(batches):
        for batch in batches:
            scores = scores_of(batch.column("text"), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return run


def keep(documents: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """The rows, with all their columns, whose text isn't predicted as toxic."""
    return filter_batches(documents, lambda batch: scores_of(batch.column("text"), model) < THRESHOLD)


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def score(documents: DataFrame, model: tuple[np.ndarray, float], modulus: int = 4, remainder: int = 2) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row."""
    ship(documents.sparkSession)
    rows = _texts(documents).withColumn("held_out", holds_out("doc_id", modulus, remainder))
    return rows.mapInArrow(_scorer(model), "doc_id long, held_out boolean, score double, predicted int")


def offending_sentences(documents: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.3) -> DataFrame:
    """``(doc_id, begin, end, sentence, score)``: byte spans of the sentences that score at least ``threshold``."""
    weights, bias = model

    def run(batches):
        for batch in batches:
            ids, at, out = batch.column("doc_id").to_pylist(), 0, []
            for features, sentence, document, rows, (opening, closing, part, cut) in bags(batch.column("text")):
                p = sigmoid(sentence_logits(features, sentence, len(document), weights, bias))
                for k in np.flatnonzero(p >= threshold):
                    base = cut[document[k]]
                    out.append((ids[at + document[k]], int(opening[k]), int(closing[k]), part[base + opening[k] : base + closing[k]].tobytes().decode("utf-8", "replace"), float(p[k])))
                at += rows
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64()))], names=["doc_id", "begin", "end", "sentence", "score"])

    ship(documents.sparkSession)
    return _texts(documents).mapInArrow(run, "doc_id long, begin long, end long, sentence string, score double")
