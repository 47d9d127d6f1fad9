"""Conversation structure repair: cheapest edits that turn roles into ``(s?(ua)+)?``.

Nodes are (rows taken, what came last: nothing, system, user or assistant). Keep, Rerole, Delete and Insert are arcs of
costs 0, 3, 4 and 3 (3 more for a truncated row that stays). Distances to the end come from Dial's bucket queue, as costs
are small integers; the audit is the ASCII-least walk over tight arcs (cost + distance after = distance before).

Rows are dealt by ranges of (conversation, turn, hash of role and text), so a task sees whole conversations in order and
parts of at most two others. Whole ones of up to ``BLOCK`` rows are settled there. The first and last conversation of a
task, and longer ones, go on as blocks of at most ``BLOCK`` rows (or ``BYTES``): texts seen in an earlier block are found by an
aggregate over (conversation, hash); each block yields its least costs between the four states; a backward pass over one
small row a block gives the distance to the end behind every block; each block is then walked for itself from all four
states; a forward pass over blocks joins the walks. So a conversation of any length is split but for that pass, which
streams because a digest of one text has an order; no task holds more than a block.

Results by definition: nulls in role and text are one space, as they are in what damage hashes; rows of a null conv_id are
a conversation of their own; rows of one turn (null turns first) stand in the order of a hash of role and text, and repeated rows are
duplicates, so equal input gives equal output. Initials are the first character as it is. A row's first fault counts:
blank, duplicate, truncated. Empty tables give empty results; columns beyond conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .runtime import durable, ship

BLOCK, BYTES = 1024, 4 << 20
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: After an inserted or reroled row: what came last, by what came last before it.
NEXT = (USER, USER, ASSISTANT, USER)
NAME = {USER: b"user", ASSISTANT: b"assistant"}
#: What came last after a kept row of a class of initials (other, s, u, a), by what came last before it; -1: not allowed.
KEEP = ((-1,) * 4, (SYSTEM, -1, -1, -1), (USER, USER, -1, USER), (-1, -1, ASSISTANT, -1))
INITIAL = {b"s": 1, b"u": 2, b"a": 3}
#: Bits of a row's code beside its class of initials.
TRUNCATED, FORCED = 4, 8
FAR = 1 << 60
END = (0, FAR, FAR, 0)


def distances(codes: bytes, after: tuple[int, ...] = END) -> list[int]:
    """Least cost to the end from each node ``4 * rows taken + last``, where ``after`` holds the costs behind the last row."""
    m = len(codes)
    base = min(after)
    dist = [FAR] * (4 * m + 4)
    # A path deletes all rows and inserts three at most, or costs less; sources differ by what inserts and a row cost.
    buckets: list[list[int]] = [[] for _ in range(4 * m + 32 + max(x - base for x in after if x < FAR))]
    for last, cost in enumerate(after):
        if cost < FAR:
            dist[4 * m + last] = cost - base
            buckets[cost - base].append(4 * m + last)
    for d, bucket in enumerate(buckets):
        for node in bucket:  # grows by arcs of cost 0 while it is read
            if dist[node] != d:
                continue
            i, last = divmod(node, 4)
            steps = [(4 * i + before, 3) for before in range(4) if NEXT[before] == last]
            if i:
                code = codes[i - 1]
                steps.append((node - 4, 4))
                if not code & FORCED:
                    extra, keep = 3 if code & TRUNCATED else 0, KEEP[code & 3]
                    for before in range(4):
                        at = 4 * i - 4 + before
                        if keep[before] == last:
                            steps.append((at, extra))
                        if NEXT[before] == last:
                            steps.append((at, 3 + extra))
            for at, cost in steps:
                if d + cost < dist[at]:
                    dist[at] = d + cost
                    buckets[d + cost].append(at)
    return [x + base if x < FAR else FAR for x in dist]


def walk(codes: bytes, dist: list[int], last: int, final: bool = True) -> tuple[str, int]:
    """The ASCII-least tight walk from state ``last`` through all rows: edits' initials and the state behind them.

    Behind the last row of a block that isn't its conversation's ``final`` one, what comes is for the next block to say.
    """
    out, i, m = [], 0, len(codes)
    while i < m or final:
        here = dist[4 * i + last]
        if i < m and here == 4 + dist[4 * i + 4 + last]:
            out.append("D")
            i += 1
        elif here == 3 + dist[4 * i + NEXT[last]]:
            out.append("I")
            last = NEXT[last]
        elif i < m:
            code = codes[i]
            extra, kept = 3 if code & TRUNCATED else 0, KEEP[code & 3][last]
            if not code & FORCED and kept >= 0 and here == extra + dist[4 * i + 4 + kept]:
                out.append("K")
                last = kept
            else:
                out.append("R")
                last = NEXT[last]
            i += 1
        else:
            break
    return "".join(out), last


@lru_cache(1 << 14)
def _known(codes: bytes) -> tuple[int, str]:
    dist = distances(codes)
    return dist[0], walk(codes, dist, NONE)[0]


def solve(codes: bytes) -> tuple[int, str]:
    """Cost and audit of a whole conversation; short ones' codes recur, so they are kept."""
    return _known(codes) if len(codes) <= 32 else _known.__wrapped__(codes)


def edited(audit: str, last: int, roles: list[bytes], texts: list[bytes]):
    """(edit, role, text) of each edit in order; of deleted rows what they were."""
    i = 0
    for edit in audit:
        if edit == "I":
            last = NEXT[last]
            yield edit, NAME[last], b""
            continue
        role, text = roles[i], texts[i]
        i += 1
        if edit == "K":
            last = KEEP[INITIAL.get(role[:1], 0)][last]
        elif edit == "R":
            last = NEXT[last]
            role = NAME[last]
        yield edit, role, text


def code_rows(roles, blank, cut, marks, seen) -> tuple[bytes, int, int, int, int]:
    """Codes of rows, counts of blank, duplicate, truncated and illegal ones; ``seen`` holds earlier hashes and grows."""
    codes, blanks, duplicates, truncated, illegal, before = bytearray(), 0, 0, 0, 0, None
    for role, is_blank, is_cut, mark in zip(roles, blank, cut, marks):
        code = INITIAL.get(role[:1], 0)
        if is_blank:
            blanks, code = blanks + 1, code | FORCED
        elif mark in seen:
            duplicates, code = duplicates + 1, code | FORCED
        elif is_cut:
            truncated, code = truncated + 1, code | TRUNCATED
        seen.add(mark)
        illegal += before is not None and before + role[:1] not in (b"su", b"ua", b"au")
        before = role[:1]
        codes.append(code)
    return bytes(codes), blanks, duplicates, truncated, illegal


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage by the crc32 of ``conv_id:turn``, with ``copies`` 0 for a dropped and 2 for a repeated one."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(h.isin(0, 1), "").when(h == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role, copies = F.when(h == 4, "user").otherwise(space("role")), F.when(h == 0, 0).when(h == 3, 2).otherwise(1)
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), copies.alias("copies"))


def _key(c: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with their faults, in ranges of their order. Rows that agree in all keys are equal, so any order of them will do."""
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r"))
    rows = rows.select(
        _key("conv_id").alias("key"), "conv_id", "turn", "copies", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"),
        (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.unhex(F.sha2(F.concat("role", F.lit("\0"), "text"), 256)).alias("mark"),
    )
    rows = rows.withColumn("copy", F.monotonically_increasing_id())
    return rows.repartitionByRange("key", "turn", "mark", "copy").sortWithinPartitions("key", "turn", "mark").drop("copy")


LISTS = ("turn", "role", "text", "blank", "cut", "mark")
TALLIES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


_DIGEST = [(n, pa.int64()) for n in TALLIES] + [("audit", pa.string()), ("repaired_sha256", pa.string())]
_EDITS = [("part", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.binary()), ("text", pa.binary())]
_OPEN = [("key", pa.string()), ("block", pa.int64())] + [(f"{n}s", pa.list_(t)) for n, t in zip(LISTS, (pa.int64(), pa.binary(), pa.binary(), pa.bool_(), pa.bool_(), pa.binary()))]


def _schema(batch: pa.RecordBatch, *fields) -> pa.Schema:
    return pa.schema([batch.schema.field("conv_id"), *(f for more in fields for f in more)])


def _rows_of(batches):
    names = ("key", "conv_id", *LISTS, "copies")
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def _first_pass(digest: bool, most: int):
    """Conversations that a task sees whole, settled; others as blocks."""

    def blocks(rows):
        """(whole so far, block of rows) of one conversation."""
        held, size, cut = [], 0, False
        for row in rows:
            for _ in range(row[-1]):
                if held and (len(held) >= most or size + len(row[4]) > BYTES):
                    yield False, held
                    held, size, cut = [], 0, True
                held.append(row[2:-1])
                size += len(row[4])
        yield not cut, held

    def run(batches):
        from pyspark import TaskContext

        number, out, size, waiting, first = TaskContext.get().partitionId() << 32, [], 0, None, True
        begun = next(batches, None)
        if begun is None:
            return
        schema, batches = _schema(begun, _DIGEST if digest else _EDITS, _OPEN), chain([begun], batches)

        def opened(key, conv, rows):
            nonlocal number
            number += 1
            return {"key": key, "conv_id": conv, "block": number, **{f"{n}s": [r[k] for r in rows] for k, n in enumerate(LISTS)}}

        for (key, conv), rows in groupby(_rows_of(batches), lambda r: r[:2]):
            if waiting:  # another conversation follows, so the one before isn't the task's last
                out += settled(waiting[1], [waiting[2]], digest)
                waiting = None
            for whole, block in blocks(rows):
                if first or not whole:
                    out.append(opened(key, conv, block))
                else:
                    waiting = (key, conv, _block(block))
                size += sum(len(r[2]) for r in block) + 64
                if len(out) >= 1000 or size > BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
            first = False
        if waiting:
            number += 1
            out.append({"key": waiting[0], "conv_id": waiting[1], "block": number, **{f"{n}s": waiting[2][n] for n in LISTS}})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _block(rows) -> dict:
    return {n: [r[k] for r in rows] for k, n in enumerate(LISTS)}


def settled(conv, blocks: list[dict], digest: bool) -> list[dict]:
    """Result rows of a conversation that is here as a whole."""
    (rows,) = blocks
    codes, *faults = code_rows(rows["role"], rows["blank"], rows["cut"], rows["mark"], set())
    cost, audit = solve(codes)
    pieces = edited(audit, NONE, rows["role"], rows["text"])
    if not digest:
        return [{"conv_id": conv, "part": 0, "place": k, "edit": e, "role": r, "text": t} for k, (e, r, t) in enumerate(pieces)]
    turns = {t for t in rows["turn"] if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    text = b"\n".join(b"%b:%b" % (r, t) for e, r, t in pieces if e != "D")
    return [{"conv_id": conv, **dict(zip(TALLIES, (gaps, *faults, cost))), "audit": audit, "repaired_sha256": hashlib.sha256(text).hexdigest()}]


def _coded(batches):
    """Each block's codes, counts and least costs between the states."""
    for batch in batches:
        out = []
        for b in batch.to_pylist():
            codes, *faults = code_rows(b["roles"], b["blanks"], b["cuts"], b["marks"], set(b["seen"] or ()))
            costs = []
            for last in range(4):
                costs += distances(codes, tuple(0 if k == last else FAR for k in range(4)))[:4]
            turns = [t for t in b["turns"] if t is not None]
            shape = {"low": turns[0], "high": turns[-1], "turns": len(set(turns))} if turns else {}
            ends = {"head": b["roles"][0][:1], "tail": b["roles"][-1][:1]} if codes else {}
            out.append({"key": b["key"], "block": b["block"], "codes": codes, "costs": costs, **dict(zip(TALLIES[1:5], faults)), **shape, **ends})
        yield pa.RecordBatch.from_pylist(out, schema=_CODED)


_CODED = pa.schema(
    [("key", pa.string()), ("block", pa.int64()), ("codes", pa.binary()), ("costs", pa.list_(pa.int64()))]
    + [(n, pa.int64()) for n in (*TALLIES[1:5], "low", "high", "turns")]
    + [("head", pa.binary()), ("tail", pa.binary())]
)
_CODED_SQL = "key string, block long, codes binary, costs array<long>, blank long, duplicate long, truncated long, illegal long, low long, high long, turns long, head binary, tail binary"


def _backward(batches):
    """Distances to the end behind each block; blocks come last first."""
    key, after = None, END
    for batch in batches:
        out = []
        for k, block, costs in zip(*(batch.column(n).to_pylist() for n in ("key", "block", "costs"))):
            final = k != key
            if final:
                # Behind the last row the end is reached at once or by insertions.
                key, after = k, tuple(distances(b"", END))
            out.append((k, block, list(after), final))
            after = tuple(min(min(costs[4 * to + last] + after[to] for to in range(4)), FAR) for last in range(4))
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], t) for j, t in enumerate((pa.string(), pa.int64(), pa.list_(pa.int64()), pa.bool_()))], names=["key", "block", "after", "final"])


def _walks(batches):
    """Each block's cost, audit and exit from each state."""
    for batch in batches:
        out = []
        for key, block, codes, after, final in zip(*(batch.column(n).to_pylist() for n in ("key", "block", "codes", "after", "final"))):
            dist = distances(codes, tuple(after))
            audits, exits = zip(*(walk(codes, dist, last, final) if dist[last] < FAR else ("", last) for last in range(4)))
            out.append({"key": key, "block": block, "before": dist[:4], "audits": audits, "exits": exits})
        yield pa.RecordBatch.from_pylist(out, schema=_WALKS)


_WALKS = pa.schema([("key", pa.string()), ("block", pa.int64()), ("before", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())), ("exits", pa.list_(pa.int64()))])


def _forward(digest: bool):
    """Blocks in order, each from the state that the one before left."""

    def run(batches):
        key, state, schema = None, None, None
        for batch in batches:
            out, schema = [], _schema(batch, _DIGEST if digest else _EDITS)
            for b in batch.to_pylist():
                if b["key"] != key:
                    if state and digest:
                        out.append(finished(state))
                    key = b["key"]
                    state = {"conv_id": b["conv_id"], "last": NONE, "part": 0, "cost": b["before"][NONE], "audit": [], "sha": hashlib.sha256(), "empty": True, "low": None, "high": None, "turns": 0, "tail": None, **dict.fromkeys(TALLIES[1:5], 0)}
                audit, last = b["audits"][state["last"]], state["last"]
                for place, (e, r, t) in enumerate(edited(audit, last, b["roles"], b["texts"])):
                    if not digest:
                        out.append({"conv_id": b["conv_id"], "part": state["part"], "place": place, "edit": e, "role": r, "text": t})
                    elif e != "D":
                        state["sha"].update(b"%b%b:%b" % (b"" if state["empty"] else b"\n", r, t))
                        state["empty"] = False
                state["last"], state["part"] = b["exits"][last], state["part"] + 1
                state["audit"].append(audit)
                for n in TALLIES[1:5]:
                    state[n] += b[n]
                if b["codes"]:
                    state["illegal"] += state["tail"] is not None and state["tail"] + b["head"] not in (b"su", b"ua", b"au")
                    state["tail"] = b["tail"]
                if b["turns_held"]:
                    state["turns"] += b["turns_held"] - (state["high"] == b["low"])
                    state["low"] = b["low"] if state["low"] is None else state["low"]
                    state["high"] = b["high"]
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if state and digest:
            yield pa.RecordBatch.from_pylist([finished(state)], schema=schema)

    def finished(state):
        gaps = state["high"] - state["low"] + 1 - state["turns"] if state["turns"] else 0
        return {**{n: state[n] for n in ("conv_id", *TALLIES[1:])}, "gaps": gaps, "audit": "".join(state["audit"]), "repaired_sha256": state["sha"].hexdigest()}

    return run


def _repair(rows: DataFrame, digest: bool, block: int) -> DataFrame:
    ship(rows.sparkSession)
    conv = StructField("conv_id", rows.schema["conv_id"].dataType)
    if digest:
        result = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    else:
        result = "part long, place long, edit string, role binary, text binary"
    result = StructType([conv, *StructType.fromDDL(result)])
    lists = "turns array<long>, roles array<binary>, texts array<binary>, blanks array<boolean>, cuts array<boolean>, marks array<binary>"
    mixed = StructType([*result, *StructType.fromDDL(f"key string, block long, {lists}")])
    first = durable(_ordered(rows).mapInArrow(_first_pass(digest, block), mixed), "repair-first")
    whole, open_ = first.where("block is null").select(result.names), first.where("block is not null")
    blocks = open_.select("key", "conv_id", "block", "turns", "roles", "texts", "blanks", "cuts", "marks")
    marks = blocks.select("key", "block", F.explode(F.array_distinct("marks")).alias("mark"))
    again = marks.groupBy("key", "mark").agg(F.min("block").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    seen = marks.join(again, ["key", "mark"]).where("block > first").groupBy("key", "block").agg(F.collect_list("mark").alias("seen"))
    coded = durable(blocks.drop("texts", "conv_id").join(seen, ["key", "block"], "left").mapInArrow(_coded, _CODED_SQL), "repair-coded")
    after = coded.select("key", "block", "costs").repartition("key").sortWithinPartitions("key", F.desc("block")).mapInArrow(_backward, "key string, block long, after array<long>, final boolean")
    walks = coded.select("key", "block", "codes").join(after, ["key", "block"]).mapInArrow(_walks, "key string, block long, before array<long>, audits array<string>, exits array<long>")
    facts = coded.drop("costs").withColumnRenamed("turns", "turns_held")
    parts = blocks.select("key", "conv_id", "block", "roles", "texts").join(facts, ["key", "block"]).join(walks, ["key", "block"])
    rest = parts.repartition("key").sortWithinPartitions("key", "block").mapInArrow(_forward(digest), result)
    return whole.unionByName(rest)


def _plain(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role, text, F.lit(1).alias("copies"))


def repair(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(conv_id, part, place, edit, role, text)``: every edit of every conversation, by part and place; D rows are gone."""
    out = _repair(_plain(conversations), False, block)
    return out.withColumns({c: F.col(c).cast("string") for c in ("role", "text")})


def audit(conversations: DataFrame, damage: bool = True, block: int = BLOCK) -> DataFrame:
    """Faults, least cost, audit and digest of the repaired text of every conv_id, by default after damage."""
    return _repair(damaged(conversations) if damage else _plain(conversations), True, block)
