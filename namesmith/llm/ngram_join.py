"""N-gram Jaccard join with adaptive multi-match prefixes.

``jaccard_components`` links documents whose sets of word shingles have a Jaccard similarity of at least
``percent``/100 and returns each document's component. All link tests are exact on 64-bit shingle hashes; nothing is
dropped, capped or sampled.

How it runs:

1. Documents with equal sets are one *class* (64-bit key of the set), so groups of exact copies collapse to one node.
2. *Screen.* In the order of their hashes, two linked sets share at least l shingles among the first
   ``size - need + l`` of each (``need``: required overlap; l falls with the size). Each class deals that prefix, four
   bytes a shingle, to hash ranges whose tasks report which of them a second class holds. A class of which fewer than l
   came back can't have a link and ends here; a shingle taken for shared by mistake only keeps a class a while longer.
3. Texts of the classes that are left are read once more (a bitmap of ``BITS`` bits, whatever their number, spares most
   others the way to the join that picks them). Their shingles are counted over those classes the same way,
   and each class orders its shared shingles from rare to frequent (counts rounded to an eighth of an octave: any order
   that all classes use is right). A class with fewer than ``need`` shared ones ends. Each other picks its l anew, of
   least estimated cost: postings probed plus estimated candidates to verify, which a larger l thins.
4. Every prefix shingle has a pivot, the class of least hash in its posting list. Classes meet at their pivots, first
   with prefixes only; where pairs have enough shared prefix shingles (the smaller l of both), their whole sets follow
   and the pairs are verified. Large pivot groups are cut into blocks: first each block is linked within itself, then
   blocks are paired except those of one component.
5. Verified links, a spanning forest per group, go through contraction to components.

A shingle that is frequent everywhere costs one entry for each ``FLUSH`` shingles of a task, not one a document, and the
number of hash ranges follows from the size of the texts. Joins of classes are sort-merge joins at every size: nothing
of which the size isn't bounded is broadcast.

Null, empty or blank text: no shingles, linked with nothing. Very long texts: a set of any size is one row. Null doc_id:
the row stays; its class's smallest non-null doc_id is its component. Repeated rows: all stay. Ties don't arise: a
component's name is its least doc_id. An empty table gives an empty result. Other columns of the input are ignored,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import components, discard, durable, ship
from .shingles import mix, shingle_sets

#: Shingles that a task gathers before it deals them (of at most so many classes), shingles of a hash range.
FLUSH, FLUSH_CLASSES, RANGE = 1_000_000, 60_000, 1_000_000
#: Classes and shingles of a block; classes that a task remembers, so as not to deal them twice.
BLOCK, BLOCK_SHINGLES, KNOWN, SALTS, BITS = 1024, 2_000_000, 500_000, 16, 1 << 24


def _class_key(tokens: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        a, b = tokens.sum(dtype=np.uint64), mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
        return int(mix(np.array([a ^ mix(np.array([b + np.uint64(len(tokens))], np.uint64))[0]], np.uint64)).view(np.int64)[0])


class _Known:
    """Whether a task has met a class lately."""

    def __init__(self):
        self.keys: set[int] = set()

    def __call__(self, key: int) -> bool:
        if key in self.keys:
            return True
        if len(self.keys) >= KNOWN:
            self.keys.clear()
        self.keys.add(key)
        return False


def required(n: int, percent: int) -> int:
    """Shingles that a linked set shares with one of ``n``."""
    return -(-percent * n // 100)


def screen_matches(n: int, percent: int) -> int:
    """l of the screen for a set of ``n``: grows with n."""
    return max(1, required(n, percent) // 12)


def _ranges(tokens: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash range and a 32-bit name within it."""
    x = mix(tokens)
    return ((x >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64), x.astype(np.uint32)


def _flush_id(seq: int) -> int:
    context = TaskContext.get()
    return (context.partitionId() if context else 0) << 32 | seq


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_batches([_batch(rows, schema)])


_TOLD = "doc_id long, n long, class long, bucket long, flush long, names binary, owners binary, counts binary"
_TOLD_ARROW = pa.schema([*((x, pa.int64()) for x in ("doc_id", "n", "class", "bucket", "flush")), *((x, pa.binary()) for x in ("names", "owners", "counts"))])


def _classes(width: int, percent: int, buckets: int, flush: int):
    """Each row's class, with ``bucket`` null; and prefixes dealt to buckets, with each flush's own row under bucket -1."""

    def run(batches):
        known, keys, needs, prefixes, seq = _Known(), [], [], [], 0

        def dealt():
            m, number = len(keys), _flush_id(seq)
            tokens = np.concatenate(prefixes)
            owner = np.repeat(np.arange(m), [len(p) for p in prefixes])
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            start = _runs(tokens)
            length = np.diff(np.r_[start, len(tokens)])
            # Shingles of several classes here are known as shared; one entry, of no owner, tells other flushes.
            local = np.bincount(owner[np.repeat(length > 1, length)], minlength=m)
            own = np.where(length == 1, owner[start], m)
            bucket, name = _ranges(tokens[start], buckets)
            order = np.lexsort((own, bucket))
            bucket, name, own = bucket[order], name[order], own[order].astype(np.uint16)
            begin = _runs(bucket)
            rows = [(None, None, None, int(bucket[i]), number, name[i:j].tobytes(), own[i:j].tobytes(), None) for i, j in zip(begin, np.r_[begin[1:], len(bucket)])]
            left = np.array(needs) - local
            rows.append((None, None, None, -1, number, np.array(keys, np.int64).tobytes(), None, left.astype(np.int32).tobytes()))
            keys.clear(), needs.clear(), prefixes.clear()
            return _batch(rows, _TOLD_ARROW)

        held = 0
        for batch in batches:
            names, sizes = [], []
            for s in shingle_sets(batch.column("text"), width):
                n = len(s)
                names.append(_class_key(s) if n else 0)
                sizes.append(n)
                if n and not known(names[-1]):
                    l = screen_matches(n, percent)
                    keys.append(names[-1])
                    needs.append(screen_matches(required(n, percent), percent))
                    prefixes.append(s[: n - required(n, percent) + l].copy())
                    held += len(prefixes[-1])
                    if held >= flush or len(keys) >= FLUSH_CLASSES:
                        yield dealt()
                        held, seq = 0, seq + 1
            none, empty = pa.nulls(len(names), pa.int64()), pa.nulls(len(names), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), none, none, empty, empty, empty], schema=_TOLD_ARROW)
        if keys:
            yield dealt()

    return run


def _runs(*sorted_keys: np.ndarray) -> np.ndarray:
    """Start of every run of equal keys."""
    n = len(sorted_keys[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_keys])
    return np.flatnonzero(new)


_SHARED = "flush long, owners binary, counts binary"
_SHARED_ARROW = pa.schema([("flush", pa.int64()), ("owners", pa.binary()), ("counts", pa.binary())])


def _met(key, group):
    """For each flush the owners of shingles of one hash range that others hold too, and how many each has."""
    if key[0].as_py() < 0:
        return _table([], _SHARED_ARROW)
    names = [np.frombuffer(x, np.uint32) for x in group["names"].to_pylist()]
    row = np.repeat(np.arange(len(names)), [len(x) for x in names])
    owner = np.concatenate([np.frombuffer(x, np.uint16) for x in group["owners"].to_pylist()])
    name = np.concatenate(names)
    order = np.argsort(name, kind="stable")
    start = _runs(name[order])
    length = np.diff(np.r_[start, len(name)])
    hit = order[np.repeat(length > 1, length)]
    pair, count = np.unique(row[hit] << 16 | owner[hit], return_counts=True)
    begin, flush, out = _runs(pair >> 16), group["flush"].to_numpy(), []
    for i, j in zip(begin, np.r_[begin[1:], len(pair)]):
        out.append((int(flush[pair[i] >> 16]), pair[i:j].astype(np.uint16).tobytes(), count[i:j].astype(np.uint32).tobytes()))
    return _table(out, _SHARED_ARROW)


def _passed(key, group):
    """Classes of one flush of which enough shingles are shared."""
    schema = pa.schema([("class", pa.int64())])
    told = group.to_pylist()
    names, left = next((np.frombuffer(r["names"], np.int64), np.frombuffer(r["counts"], np.int32).astype(np.int64)) for r in told if r["names"] is not None)
    left = np.r_[left, 0]  # the last is that of entries without an owner
    for r in told:
        if r["names"] is None:
            left[np.frombuffer(r["owners"], np.uint16)] -= np.frombuffer(r["counts"], np.uint32)
    return pa.Table.from_arrays([pa.array(names[left[:-1] <= 0])], schema=schema)


def _bitmap(classes: DataFrame) -> np.ndarray:
    """``BITS`` bits, of which those of the classes' keys are set; built by the executors."""
    bit = F.pmod(F.col("class"), F.lit(BITS))
    words = classes.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(class, {BITS}) % 64 as int))")).alias("bits")).toPandas()  # BITS / 64 rows at most
    out = np.zeros(BITS // 64, np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out


def _texts_of_classes(width: int, bitmap: np.ndarray):
    """``(class, text)``: texts with their class where the bitmap has it, a repeated class once."""

    def able(key: int) -> bool:
        bit = key % BITS
        return bool(int(bitmap[bit >> 6]) >> (bit & 63) & 1)

    def run(batches):
        known = _Known()
        for batch in batches:
            keys = [_class_key(s) if len(s) else None for s in shingle_sets(batch.column("text"), width)]
            mask = pa.array([k is not None and able(k) and not known(k) for k in keys])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()).filter(mask), batch.column("text").filter(mask)], names=["class", "text"])

    return run


_SETS = "flush long, classes binary, sizes binary, tokens binary, total long"
_SETS_ARROW = pa.schema([("flush", pa.int64()), *((x, pa.binary()) for x in ("classes", "sizes", "tokens")), ("total", pa.int64())])


def _sets(width: int, flush: int):
    """Packed shingle sets of ``(class, text)``."""

    def run(batches):
        keys, sets, held, seq = [], [], 0, 0

        def packed():
            row = (_flush_id(seq), np.array(keys, np.int64).tobytes(), np.array([len(s) for s in sets], np.int64).tobytes(), np.concatenate(sets).tobytes(), sum(map(len, sets)))
            keys.clear(), sets.clear()
            return _batch([row], _SETS_ARROW)

        for batch in batches:
            for key, s in zip(batch.column("class").to_pylist(), shingle_sets(batch.column("text"), width)):
                keys.append(key)
                sets.append(s)
                held += len(s)
                if held >= flush:
                    yield packed()
                    held, seq = 0, seq + 1
        if keys:
            yield packed()

    return run


def _in_ranges(tokens: bytes, buckets: int):
    """Distinct shingles of a flush in the order of their hash ranges, how often each occurs, range, 32-bit name."""
    token, count = np.unique(np.frombuffer(tokens, np.uint64), return_counts=True)
    bucket, name = _ranges(token, buckets)
    order = np.argsort(bucket, kind="stable")
    return token[order], count[order], bucket[order], name[order]


_DEALT = "bucket long, flush long, names binary, counts binary"
_DEALT_ARROW = pa.schema([("bucket", pa.int64()), ("flush", pa.int64()), ("names", pa.binary()), ("counts", pa.binary())])


def _deal(buckets: int):
    def run(batches):
        for batch in batches:
            for flush, tokens in zip(batch.column("flush").to_pylist(), batch.column("tokens").to_pylist()):
                _, count, bucket, name = _in_ranges(tokens, buckets)
                begin = _runs(bucket)
                yield _batch([(int(bucket[i]), flush, name[i:j].tobytes(), count[i:j].astype(np.uint32).tobytes()) for i, j in zip(begin, np.r_[begin[1:], len(bucket)])], _DEALT_ARROW)

    return run


_CODES_ARROW = pa.schema([("flush", pa.int64()), ("bucket", pa.int64()), ("codes", pa.binary())])


def _count(key, group):
    """Frequencies of the shingles of one hash range, as codes: 8 log2 of the number of classes, rounded down."""
    names = [np.frombuffer(x, np.uint32) for x in group["names"].to_pylist()]
    count = np.concatenate([np.frombuffer(x, np.uint32) for x in group["counts"].to_pylist()])
    _, of = np.unique(np.concatenate(names), return_inverse=True)
    code = np.minimum(np.floor(8 * np.log2(np.bincount(of, count))), 255).astype(np.uint8)[of]
    edges = np.r_[0, np.cumsum([len(x) for x in names])]
    return _table([(flush, key[0].as_py(), code[i:j].tobytes()) for flush, i, j in zip(group["flush"].to_pylist(), edges, edges[1:])], _CODES_ARROW)


def prefix_choice(n: int, need: int, frequencies: np.ndarray) -> tuple[int, int]:
    """(matches l, prefix length among the shared shingles) of least estimated cost.

    Cost of l: postings that the prefix probes, plus the candidates it may bring forward - at most one for every l
    matches - each at the price of merging two sets.
    """
    spare = len(frequencies) - need
    total = np.cumsum(frequencies)
    best = None
    for l in (1, 2, 3, 4, 6, 8, 12, 16):
        if l > need:
            break
        q = spare + l
        probes = float(total[q - 1])
        cost = probes + (probes - q) / l * n / 8
        if best is None or cost < best[0]:
            best = (cost, l, q)
    return best[1], best[2]


_SURVIVOR = "class long, n long, matches int, prefix array<long>, tokens binary"
_SURVIVOR_ARROW = pa.schema([("class", pa.int64()), ("n", pa.int64()), ("matches", pa.int32()), ("prefix", pa.list_(pa.int64())), ("tokens", pa.binary())])


def _prefixes(percent: int, buckets: int):
    """Classes of one flush with their shared shingles and the prefix that each chooses."""

    def run(sets, codes):
        out = []
        for classes, sizes, tokens in zip(*(sets[x].to_pylist() for x in ("classes", "sizes", "tokens"))):
            token = _in_ranges(tokens, buckets)[0]
            parts = dict(zip(codes["bucket"].to_pylist(), codes["codes"].to_pylist()))
            code = np.frombuffer(b"".join(parts[b] for b in sorted(parts)), np.uint8)
            order = np.argsort(token)
            token, code = token[order], code[order]
            names, sizes, tokens = np.frombuffer(classes, np.int64), np.frombuffer(sizes, np.int64), np.frombuffer(tokens, np.uint64)
            code = code[np.searchsorted(token, tokens)]
            edges = np.r_[0, np.cumsum(sizes)]
            for name, n, i, j in zip(names.tolist(), sizes.tolist(), edges, edges[1:]):
                shared = code[i:j] > 0
                own, frequency = tokens[i:j][shared], code[i:j][shared]
                need = required(n, percent)
                if len(own) >= need:
                    order = np.lexsort((own, frequency))
                    l, q = prefix_choice(n, need, np.exp2(frequency[order] / 8))
                    out.append((name, n, l, own[order[:q]].view(np.int64), own.tobytes()))
        return _table(out, _SURVIVOR_ARROW)

    return run


def _together(owner: np.ndarray, token: np.ndarray, m: int) -> np.ndarray:
    """How many tokens each pair of owners shares (m x m)."""
    out = np.zeros((m, m), np.int32)
    order = np.argsort(token, kind="stable")
    owner, start = owner[order], _runs(token[order])
    length = np.diff(np.r_[start, len(token)])
    for i, k in zip(start[(length > 1) & (length <= 48)], length[(length > 1) & (length <= 48)]):
        own = owner[i : i + k]
        out[own[:, None], own[None, :]] += 1
    wide = np.flatnonzero(length > 48)
    for at in range(0, len(wide), 2048):
        x = np.zeros((m, min(2048, len(wide) - at)), np.float32)
        for c, r in enumerate(wide[at : at + 2048]):
            x[owner[start[r] : start[r] + length[r]], c] = 1
        out += (x @ x.T).astype(np.int32)
    return out


def able_pairs(names, sizes, matches, prefixes, labels, sides, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a group's members that share enough prefix shingles and may be linked by their sizes.

    ``sides``: 0 or 1; if both occur, only pairs across count. Pairs of one non-negative label are known to be connected.
    """
    m = len(names)
    shared = _together(np.repeat(np.arange(m), [len(p) for p in prefixes]), np.concatenate(prefixes), m)
    able = shared >= np.minimum(matches[:, None], matches[None, :])
    able &= 100 * np.minimum(sizes[:, None], sizes[None, :]) >= percent * np.maximum(sizes[:, None], sizes[None, :])
    able &= (labels[:, None] != labels[None, :]) | (labels[:, None] < 0)
    if sides.min() != sides.max():
        able &= sides[:, None] != sides[None, :]
    return np.nonzero(np.triu(able, 1))


def links_of_group(names, sizes, matches, prefixes, tokens, labels, sides, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the verified links among the members of a group."""
    m = len(names)
    i, j = able_pairs(names, sizes, matches, prefixes, labels, sides, percent)
    if not len(i):
        return []
    if len(i) > 4 * m:
        held = [np.frombuffer(t, np.uint64) for t in tokens]
        overlap = _together(np.repeat(np.arange(m), [len(t) for t in held]), np.concatenate(held), m)[i, j]
    else:
        overlap = np.array([len(np.intersect1d(np.frombuffer(tokens[a], np.uint64), np.frombuffer(tokens[b], np.uint64), assume_unique=True)) for a, b in zip(i, j)])
    good = 100 * overlap >= percent * (sizes[i] + sizes[j] - overlap)
    parent = list(range(m))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in zip(i[good].tolist(), j[good].tolist()):
        if (x := root(a)) != (y := root(b)):
            parent[max(x, y)] = min(x, y)
            out.append((int(names[a]), int(names[b])))
    return out


def _columns(group):
    column = lambda x: group[x].to_numpy()
    prefixes = [np.asarray(p, np.int64) for p in group["prefix"].to_pylist()]
    return (column("class"), column("n"), column("matches"), prefixes), (column("label"), column("side"))


def _candidates(percent: int):
    """Members of a group that have a partner by their prefixes."""
    schema = pa.schema([("pivot", pa.int64()), ("i", pa.int64()), ("j", pa.int64()), ("class", pa.int64()), ("label", pa.int64()), ("side", pa.int32())])

    def run(key, group):
        own = np.zeros(0, np.int64)
        if len(group) > 1:
            left, right = _columns(group)
            own = np.unique(np.concatenate(able_pairs(*left, *right, percent)))
        return group.select(schema.names).take(pa.array(own)).cast(schema)

    return run, "pivot long, i long, j long, class long, label long, side int"


def _link(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(key, group):
        found = []
        if len(group) > 1:
            left, right = _columns(group)
            found = links_of_group(*left, group["tokens"].to_pylist(), *right, percent)
        return pa.Table.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], schema=schema)

    return run


def _verified(placed: DataFrame, survivors: DataFrame, percent: int) -> DataFrame:
    """Links within groups (pivot, i, j); whole sets go only where their prefixes found a partner."""
    keys = ["pivot", "i", "j"]
    prefixed = placed.join(survivors.select("class", "n", "matches", "prefix").hint("merge"), "class")
    run, schema = _candidates(percent)
    candidates = durable(prefixed.groupBy(*keys).applyInArrow(run, schema), "candidates")
    return durable(candidates.join(survivors.hint("merge"), "class").groupBy(*keys).applyInArrow(_link(percent), "a long, b long"), "links")


def _links(survivors: DataFrame, percent: int, block: int, block_shingles: int) -> DataFrame:
    """Verified links of all classes: every pair with a common prefix shingle meets at that shingle's pivot."""
    posts = survivors.select("class", F.explode("prefix").alias("token"))
    pivots = posts.groupBy("token").agg(F.min(F.struct(F.xxhash64("class"), F.col("class"))).getField("class").alias("pivot"), F.count("*").alias("k")).where("k > 1").select("token", "pivot")
    members = posts.join(pivots.hint("merge"), "token").select("pivot", "class").distinct()
    weights = survivors.select("class", F.size("prefix").alias("w"), (F.length("tokens") / 8).alias("t"))
    members = durable(members.join(weights.hint("merge"), "class").select("pivot", "class", "t"), "members")
    groups = members.groupBy("pivot").agg(F.greatest(F.ceil(F.count("*") / (2 * block)), F.ceil(F.sum("t") / block_shingles)).cast("long").alias("blocks"), F.count("*").alias("k")).where("k > 1").drop("k")
    placed = members.join(groups.hint("merge"), "pivot").withColumn("i", F.pmod(F.xxhash64("class", F.lit(1)), "blocks"))
    first = _verified(placed.select("pivot", "i", F.col("i").alias("j"), "class", F.lit(-1).cast("long").alias("label"), F.lit(0).alias("side")), survivors, percent)
    large = durable(placed.where("blocks > 1").select("pivot", "class"), "large")
    if large.isEmpty():
        return first
    # Blocks of one component each, where a component fills one, and blocks of mixed small components.
    joined = components(first, name="block-components")
    labelled = large.join(joined, large["class"] == joined["node"], "left").select("pivot", "class", F.coalesce("root", "class").alias("label"))
    share = labelled.groupBy("pivot", "label").agg(F.count("*").alias("k"))
    mixed = share.groupBy("pivot").agg(F.sum(F.when(F.col("k") < block, F.col("k")).otherwise(0)).alias("small"))
    spread = labelled.join(share, ["pivot", "label"]).join(mixed, "pivot").select(
        "pivot", "class", "label", F.when(F.col("k") >= block, F.col("label")).alias("whole"),
        F.when(F.col("k") >= block, F.pmod(F.xxhash64("class", F.lit(2)), F.ceil(F.col("k") / block))).otherwise(F.pmod(F.xxhash64("label", F.lit(3)), F.greatest(F.ceil(F.col("small") / block), F.lit(1)))).alias("part"),
    )
    spread = durable(spread.withColumn("own", F.xxhash64("whole", "part")), "spread")
    # Pairs of blocks first, from one row a block; then each class goes to its block's pairs.
    blocks = spread.select("pivot", "own", "whole").distinct()
    others = blocks.select("pivot", F.col("own").alias("other"), F.col("whole").alias("other_whole"))
    pairs = blocks.join(others, "pivot").where("whole is null or other_whole is null or whole <> other_whole").select("pivot", "own", "other")
    pairs = spread.select("pivot", "class", "label", "own").join(pairs, ["pivot", "own"])
    pairs = pairs.select("pivot", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "class", "label", F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"))
    return first.union(_verified(pairs, survivors, percent))


def _survivors(texts: DataFrame, told: DataFrame, width: int, percent: int, flush: int, share: int) -> DataFrame:
    """``(class, n, matches, prefix, tokens)`` of the classes that pass both counts."""
    dealt = told.where("bucket is not null")
    shared = dealt.select("bucket", "flush", "names", "owners").where("bucket >= 0").groupBy("bucket").applyInArrow(_met, _SHARED)
    own = dealt.where("bucket = -1").select("flush", "names", "owners", "counts")
    passed = own.union(shared.select("flush", F.lit(None).cast("binary").alias("names"), "owners", "counts")).groupBy("flush").applyInArrow(_passed, "class long")
    passed = durable(passed, "passed")
    left = texts.select("text").mapInArrow(_texts_of_classes(width, _bitmap(passed)), "class long, text string").join(passed.hint("merge"), "class", "left_semi").dropDuplicates(["class"])
    sets = durable(left.mapInArrow(_sets(width, flush), _SETS), "sets")
    buckets = max(1, (sets.agg(F.sum("total")).first()[0] or 0) // share)
    counted = sets.select("flush", "tokens").mapInArrow(_deal(buckets), _DEALT).groupBy("bucket").applyInArrow(_count, "flush long, bucket long, codes binary")
    out = durable(sets.groupBy("flush").cogroup(counted.groupBy("flush")).applyInArrow(_prefixes(percent, buckets), _SURVIVOR), "survivors")
    discard(passed, sets)
    return out


def jaccard_components(documents: DataFrame, width: int = 5, percent: int = 75, block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES, flush: int = FLUSH, share: int = RANGE) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``documents(doc_id, text)``; see the module's docstring."""
    ship(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # A word and its space take about six bytes, and a third of the shingles is dealt.
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    told = durable(texts.mapInArrow(_classes(width, percent, max(1, size // 18 // share), flush), _TOLD), "classes")
    roots = components(_links(_survivors(texts, told, width, percent, flush, share), percent, block, block_shingles))
    rows = told.where("bucket is null").select("doc_id", F.col("n").alias("n_shingles"), "class")
    least = rows.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("first"))
    linked = least.join(roots, least["class"] == roots["node"]).select("class", "first", "root")
    # The least doc_id of a component goes to SALTS places, so that a large component isn't one task's.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    joint = durable(linked.groupBy("root").agg(F.min("first").alias("component_id")), "joint").select("root", "component_id", salts)
    named = linked.withColumn("salt", F.pmod(F.xxhash64("class"), F.lit(SALTS)).cast("int")).join(joint, ["root", "salt"]).select(F.col("class").alias("key"), "component_id")
    alone = least.join(roots, least["class"] == roots["node"], "left_anti").select(F.col("class").alias("key"), F.col("first").alias("component_id"))
    sets = rows.where("n_shingles > 0").join(named.union(alone), F.col("class") == F.col("key"))
    return sets.select("doc_id", "n_shingles", "component_id").union(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
