"""Indel similarity: 200 * LCS / (len a + len b), with a bit-parallel longest common subsequence.

The kernel moves all pairs of a batch at once, one 64-bit word each; texts of more than 64 characters go one by one, with
a longer integer. ``register`` also makes it callable from SQL. Pairs come here only after blocking and a bound on lengths.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence; one machine-independent integer holds a row of the table."""
    if len(a) > len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & masks.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


WORD, TABLE = 64, 1 << 22


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts, numbered, and the bounds of each text."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), np.r_[0, np.cumsum(size)]


def lcs_all(a: list[str], b: list[str]) -> np.ndarray:
    """``lcs`` of each pair."""
    out = np.zeros(len(a), np.int64)
    short = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    for k in [k for k, (x, _) in enumerate(short) if len(x) > WORD]:
        out[k] = lcs(*short[k])
    able = [k for k, (x, _) in enumerate(short) if 0 < len(x) <= WORD]
    if not able:
        return out
    able.sort(key=lambda k: -len(short[k][1]))  # so that those still to be read are the first
    codes, edges = _codes([short[k][e] for e in (0, 1) for k in able])
    letters, codes = np.unique(codes, return_inverse=True)
    m = len(able)
    step = max(1, TABLE // len(letters))
    for low in range(0, m, step):
        high = min(m, low + step)
        start, stop = edges[low:high], edges[low + 1 : high + 1]
        masks = np.zeros((high - low, len(letters)), np.uint64)
        own = np.repeat(np.arange(high - low), stop - start)
        bit = np.arange(len(own)) - np.repeat(start - start[0], stop - start)
        np.bitwise_or.at(masks, (own, codes[start[0] : stop[-1]]), np.uint64(1) << bit.astype(np.uint64))
        full = np.uint64(2**64 - 1) >> (np.uint64(WORD) - (stop - start).astype(np.uint64))
        row = full.copy()
        begin, size = edges[m + low : m + high], np.diff(edges[m + low : m + high + 1])
        live = np.searchsorted(-size, -np.arange(size[0]), "left")
        here = np.arange(high - low)
        for j, n in enumerate(live):
            r = row[:n]
            hit = r & masks[here[:n], codes[begin[:n] + j]]
            row[:n] = ((r + hit) | (r - hit)) & full[:n]
        out[able[low:high]] = stop - start - np.bitwise_count(row)
    return out


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    """``ratio`` of each pair of texts."""
    both = np.fromiter((len(x) + len(y) for x, y in zip(a, b)), np.int64, len(a))
    return np.where(both > 0, 200.0 * lcs_all(a, b) / np.maximum(both, 1), 100.0)


def ratio(a: str | None, b: str | None) -> float | None:
    """0 to 100; two empty texts are equal; null if either is null."""
    if a is None or b is None:
        return None
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def best_match(texts: list[str], values: list[str], threshold: float, accept=lambda text, value: True) -> dict[str, str]:
    """For each distinct text the acceptable value of highest ratio, at least ``threshold``; the first of equals; '' if none."""
    texts, out = list(dict.fromkeys(texts)), {}
    sizes = np.array([len(v) for v in values], np.int64)
    for low in range(0, len(texts), 4096):
        part = texts[low : low + 4096]
        own = np.array([len(t) for t in part], np.int64)[:, None]
        i, j = np.nonzero(200.0 * np.minimum(own, sizes) >= threshold * (own + sizes))
        found = ratios([part[k] for k in i], [values[k] for k in j]) if len(i) else np.zeros(0)
        best: dict[str, tuple[float, str]] = {}
        for k in np.flatnonzero(found >= threshold).tolist():
            text, value = part[i[k]], values[j[k]]
            if (text not in best or found[k] > best[text][0]) and accept(text, value):
                best[text] = (found[k], value)
        out.update({t: best[t][1] if t in best else "" for t in part})
    return out


def _sorted(text: str | None) -> str | None:
    return None if text is None else " ".join(sorted(text.split()))


def _indel(a: pd.Series, b: pd.Series) -> pd.Series:
    out = np.full(len(a), np.nan)
    there = np.flatnonzero((a.notna() & b.notna()).to_numpy())
    out[there] = ratios(a.iloc[there].tolist(), b.iloc[there].tolist())
    return pd.Series(out)  # NaN is null


def _token_sort(a: pd.Series, b: pd.Series) -> pd.Series:
    return _indel(a.map(_sorted, na_action="ignore"), b.map(_sorted, na_action="ignore"))


_indel.__annotations__ = _token_sort.__annotations__ = {}  # the kind of function is given below


def _udf(f):
    return F.pandas_udf(f, "double", F.PandasUDFType.SCALAR)


def indel_ratio(a: Column, b: Column) -> Column:
    return _udf(_indel)(a, b)


def token_sort_ratio(a: Column, b: Column) -> Column:
    return indel_ratio(*(F.array_join(F.array_sort(F.split(c, " ")), " ") for c in (a, b)))


def length_bound(a: Column, b: Column, threshold: float) -> Column:
    """Whether lengths allow a ratio of ``threshold``: at most 200 * shorter / both."""
    return 200.0 * F.least(F.length(a), F.length(b)) >= threshold * (F.length(a) + F.length(b))


def register(spark: SparkSession) -> None:
    """SQL functions ``indel_ratio`` and ``token_sort_ratio``."""
    spark.udf.register("indel_ratio", _udf(_indel))
    spark.udf.register("token_sort_ratio", _udf(_token_sort))
