"""Quality by compression: texts that a dictionary built from good text compresses better than one from bad text.

Two zstandard dictionaries are built from labelled samples, one from good and one from bad text. A text is cut into
blocks of ``BLOCK`` bytes (all of them: whole texts count), each block is compressed with both dictionaries, and
(bad size - good size) / (bad size + good size) over the whole text is the normalised compressed-size difference. A
logistic fit on labelled rows that the dictionaries haven't seen turns it into a calibrated score.

At most ``SAMPLE`` labelled rows that aren't held out are used, of which every second one goes into the dictionaries
and the others into the calibration; of a longer text, ``FIT_BLOCKS`` blocks from evenly spread places. So at most
SAMPLE * FIT_BLOCKS * BLOCK bytes come to the driver. Scoring reads every block of every text.

Null and empty texts have difference 0. Very long texts are more blocks. Null doc_ids and repeated rows keep their rows;
without labels of both kinds every score is 0.5; an empty table gives an empty result. Other columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import labelled_texts, logistic, sigmoid
from .runtime import holds_out, ship
from .shingles import utf8_buffers

SAMPLE, FIT_BLOCKS, BLOCK, DICTIONARY, LEVEL = 4000, 16, 4096, 96 << 10, 3


def build(texts: list[bytes], size: int = DICTIONARY) -> bytes:
    """A dictionary from texts; their plain ends where there is too little for the trainer."""
    pieces = [t[i : i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(size, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-size:]


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if len(dictionary) < 8:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False)


def difference(column: pa.Array, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> np.ndarray:
    """The normalised compressed-size difference of each row's text."""
    raw, offsets = utf8_buffers(column)
    view = memoryview(np.ascontiguousarray(raw))
    out = np.zeros(len(offsets) - 1)
    for k, (i, j) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        a = b = 0
        for at in range(i, j, BLOCK):
            piece = view[at : min(j, at + BLOCK)]
            a += len(good.compress(piece))
            b += len(bad.compress(piece))
        if a + b:
            out[k] = (b - a) / (a + b)
    return out


def spread(text: bytes) -> bytes:
    """The text, or as many of its blocks as a fit may take, from evenly spread places."""
    blocks = -(-len(text) // BLOCK)
    if blocks <= FIT_BLOCKS:
        return text
    return b"".join(text[k * BLOCK : (k + 1) * BLOCK] for k in (i * blocks // FIT_BLOCKS for i in range(FIT_BLOCKS)))


def _spread(batches):
    for batch in batches:
        texts = [spread(t.as_py().encode()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), batch.column("y").cast(pa.int32())], names=["text", "y"])


def fit(documents: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, label: str = "quality", limit: int = SAMPLE):
    """(good dictionary, bad dictionary, slope, intercept) from a bounded labelled sample."""
    ship(documents.sparkSession)
    rows = labelled_texts(documents, labels, label, modulus, remainder, limit).where("text is not null and text <> ''")
    rows = rows.mapInArrow(_spread, "text binary, y int").toPandas()
    rows = rows.iloc[np.argsort([hash_of(t) for t in rows["text"]], kind="stable")]
    y, texts = rows["y"].to_numpy(), list(rows["text"])
    if not len(y) or y.min() == y.max():
        return b"", b"", 0.0, 0.0
    good, bad = (build([t for t, v in zip(texts[::2], y[::2]) if v == k]) for k in (1, 0))
    x = difference(pa.array([t.decode("utf-8", "replace") for t in texts[1::2]]), compressor(good), compressor(bad))
    slope, intercept = logistic(x * 10, y[1::2].astype(float))
    return good, bad, slope * 10, intercept


def hash_of(text: bytes) -> int:
    import zlib

    return zlib.crc32(text)


def score(documents: DataFrame, model, modulus: int = 5, remainder: int = 0) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row."""
    good, bad, slope, intercept = model

    def run(batches):
        a, b = compressor(good), compressor(bad)
        for batch in batches:
            scores = sigmoid(slope * difference(batch.column("text"), a, b) + intercept)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array((scores >= 0.3).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("held_out", holds_out("doc_id", modulus, remainder))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
