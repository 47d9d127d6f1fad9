"""License scan: passages against licence templates by the Dice coefficient over word bigrams.

Text is normalised (A-Z lower-cased, all but a-z and 0-9 to spaces); a passage gives a set of word bigrams A. For a
template's set B, Dice = 2|A and B| / (|A| + |B|) can reach ``THRESHOLD`` t only if
t/(2-t) |B| <= |A| <= (2-t)/t |B|. Passages are

* every line, against the notices (``TEMPLATES``), and
* every window of a template's number of words, one word apart, over the whole text, whatever its line breaks (a
  shorter text is one window), against the notices and the licence bodies (``bodies()``, the files of license_texts).

Only passages are looked at that hold at least t/(2-t) |B| of a template's bigrams (as |A and B| <= |A|, no other can
match), so this loses none. Bigrams are told apart by 64-bit hashes.

Per document: its best template, that Dice and the number of lines that match a notice as a whole; a notice or body
inside a longer line, or over several, counts no line. A body comes before any notice, as notices are parts of bodies;
then the larger Dice wins, ties go to the alphabetically first. A body's name is that of its file and ``-text``. Null
and empty texts and those of fewer than two words match nothing. Very long texts have more windows. Null doc_ids and
repeated rows keep their rows; an empty table gives an empty result. Other columns of the input are ignored, whatever
their names.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import ship
from .shingles import _LOWER, _STEP, mix, slices, span_hashes, utf8_buffers, word_spans

_OTHER = np.ones(256, bool)
_OTHER[[*range(48, 58), *range(97, 123)]] = False
THRESHOLD = 0.75
#: Public licence notices, one passage each.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
}


def bigrams_of(text: str) -> list[str]:
    words = re.sub("[^a-z0-9]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def bodies() -> dict[str, str]:
    """Whole licence texts by name."""
    folder = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts")
    out = {}
    for name in sorted(os.listdir(folder)):
        with open(os.path.join(folder, name), encoding="utf-8") as f:
            out[name.removesuffix(".txt") + "-text"] = f.read()
    return out


class Words:
    """Words and bigrams of some bytes: hash of the bigram that begins at each word, and whether its words share a document."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        low = _LOWER[raw]
        self.starts, ends, self.first = word_spans(low, offsets, _OTHER)
        words = span_hashes(low, self.starts, ends) if len(self.starts) else np.zeros(0, np.uint64)
        self.document = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.bigrams = mix(words[:-1] * _STEP[0] + words[1:])
        self.inside = self.document[:-1] == self.document[1:]


class Templates:
    """Bigram sets of notices and bodies as rows of a table over all their bigrams; notices come first."""

    def __init__(self, notices: dict[str, str], texts: dict[str, str], threshold: float):
        self.threshold, self.low, self.high = threshold, threshold / (2 - threshold), (2 - threshold) / threshold
        self.names, self.notices = [*sorted(notices), *sorted(texts)], len(notices)
        found = []
        for text in [*map(notices.get, sorted(notices)), *map(texts.get, sorted(texts))]:
            raw = np.frombuffer(text.encode(), np.uint8)
            found.append(Words(raw, np.array([0, len(raw)])))
        self.window = np.array([len(f.bigrams) for f in found], int)
        self.known = np.unique(np.concatenate([np.zeros(0, np.uint64), *(f.bigrams for f in found)]))
        self.holds = np.zeros((len(found), len(self.known)), bool)
        for row, f in zip(self.holds, found):
            row[np.searchsorted(self.known, f.bigrams)] = True
        self.size = self.holds.sum(1)

    def dice(self, shared, size, t: int):
        """Dice where the size bounds hold, else 0."""
        return np.where((size >= self.size[t] * self.low) & (size <= self.size[t] * self.high), 2.0 * shared / np.maximum(size + self.size[t], 1), 0.0)

    def best_window(self, bigrams: np.ndarray, place: np.ndarray, before: np.ndarray, t: int) -> float:
        """Largest Dice of a window of one document; ``before`` is each bigram's last place before this one, or -1."""
        n, w = len(bigrams), int(self.window[t])
        count = max(n - w, 0) + 1
        # A place is the first of its bigram in the windows that begin after the place before and reach it.
        at = np.arange(n)
        begin, end = np.maximum(np.maximum(before + 1, at - w + 1), 0), np.minimum(at, count - 1) + 1
        real = begin < end
        shared = real & (place >= 0) & self.holds[t][place]
        size, common = (np.cumsum(np.bincount(begin[x], minlength=count + 1) - np.bincount(end[x], minlength=count + 1))[:count] for x in (real, shared))
        return float(self.dice(common, size, t).max())

    def scan(self, raw: np.ndarray, offsets: np.ndarray) -> list[tuple]:
        """(template's number or None, Dice, matching lines) of each document."""
        documents = len(offsets) - 1
        best: list = [None] * documents
        n_lines = np.zeros(documents, np.int64)
        words = Words(raw, offsets)
        if not len(words.bigrams) or not len(self.known):
            return [(None, 0.0, 0)] * documents
        place = np.minimum(np.searchsorted(self.known, words.bigrams), len(self.known) - 1)
        place = np.where(words.inside & (self.known[place] == words.bigrams), place, -1)
        hits = np.flatnonzero(place >= 0)

        def offer(d: int, t: int, dice: float):
            if dice >= self.threshold:
                key = (t < self.notices, -dice, self.names[t], t)
                best[d] = min(best[d], key) if best[d] else key

        # Lines are numbered over the slice; a document begins a new one.
        breaks = np.r_[0, np.cumsum(raw == 10)]
        line = breaks[words.starts] + words.document
        whole = hits[line[hits] == line[hits + 1]]
        width = len(self.known)
        pairs = np.unique(line[whole] * width + place[whole])
        own, held = pairs // width, pairs % width
        matched = []
        for t in range(self.notices):
            lines, common = np.unique(own[self.holds[t][held]], return_counts=True)
            able = common >= self.size[t] * self.low
            for k, x in zip(lines[able].tolist(), common[able].tolist()):
                i, j = np.searchsorted(line, [k, k + 1])
                dice = float(self.dice(x, len(np.unique(words.bigrams[i : j - 1])), t))
                if dice >= self.threshold:
                    matched.append(k)
                    offer(int(words.document[i]), t, dice)
        if matched:
            at = np.searchsorted(line, np.unique(matched))
            n_lines += np.bincount(words.document[at], minlength=documents)

        pairs = np.unique(words.document[hits] * width + place[hits])
        own, held = pairs // width, pairs % width
        wanted: dict[int, list[int]] = {}
        for t in range(len(self.names)):
            for d in np.flatnonzero(np.bincount(own[self.holds[t][held]], minlength=documents) >= max(1, self.size[t] * self.low)).tolist():
                wanted.setdefault(d, []).append(t)
        for d, templates in wanted.items():
            i, j = words.first[d], words.first[d + 1] - 1
            bigrams = words.bigrams[i:j]
            order = np.argsort(bigrams, kind="stable")
            before = np.full(j - i, -1)
            same = bigrams[order[1:]] == bigrams[order[:-1]]
            before[order[1:][same]] = order[:-1][same]
            for t in templates:
                offer(d, t, self.best_window(bigrams, place[i:j], before, t))
        return [(b[3], -b[1], n) if b else (None, 0.0, n) for b, n in zip(best, n_lines.tolist())]


def scan(documents: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, texts: dict[str, str] | None = None) -> DataFrame:
    """``(doc_id, license, score, n_lines)`` of every row; license is null and score 0 where nothing matches."""
    known = Templates(templates, bodies() if texts is None else texts, threshold)

    def run(batches):
        for batch in batches:
            raw, offsets = utf8_buffers(batch.column("text"))
            found = [x for _, _, part, cut in slices(raw, offsets) for x in known.scan(part, cut)]
            names = [None if t is None else known.names[t] for t, _, _ in found]
            columns = [batch.column("doc_id"), pa.array(names, pa.string()), pa.array([x for _, x, _ in found], pa.float64()), pa.array([n for _, _, n in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "license", "score", "n_lines"])

    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, license string, score double, n_lines long")


def oracle(templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for ``scan`` of texts whose licences are lines; windows and bodies have no twin."""
    rows = ", ".join("('{}', {})".format(n, str(bigrams_of(t))) for n, t in sorted(templates.items()))
    return f"""
with templates(name, b) as (values {rows}),
numbered as (select row_number() over () as r, doc_id, text from documents),
lines as (select r, unnest(string_split(text, chr(10))) as line from numbered),
worded as (select row_number() over () as l, r, string_split(trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')), ' ') as w from lines),
sets as (select l, r, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as a from worded where len(w) > 1),
hits as (select l, r, name, 2.0e0 * len(list_intersect(a, b)) / (len(a) + len(b)) as dice from sets, templates
         where len(a) >= len(b) * {threshold / (2 - threshold)!r}::double and len(a) <= len(b) * {(2 - threshold) / threshold!r}::double),
best as (select r, min_by(name, struct_pack(d := -dice, n := name)) as license, max(dice) as score, count(distinct l) as n_lines from hits where dice >= {threshold!r}::double group by r)
select doc_id, license, coalesce(score, 0.0e0) as score, coalesce(n_lines, 0) as n_lines from numbered left join best using (r)
"""
