import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from namesmith.llm import repair
from namesmith.llm.registry import QUERIES
from namesmith.llm.runtime import table

SF = "/root/testdata/sf0.01"
NAMES = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def cheapest(rows):
    """(cost, audit) by a recursion over whole audits: rows are (initial, forced, truncated)."""

    @lru_cache(None)
    def best(i, last, inserted):
        ways = [(0, "")] if i == len(rows) and last in "-a" else []
        follow = {"-": "u", "s": "u", "u": "a", "a": "u"}[last]
        if inserted < 2:
            cost, rest = best(i, follow, inserted + 1)
            ways.append((cost + 3, "I" + rest))
        if i < len(rows):
            initial, forced, truncated = rows[i]
            cost, rest = best(i + 1, last, 0)
            ways.append((cost + 4, "D" + rest))
            if not forced:
                extra = 3 * truncated
                if initial == follow or (last == "-" and initial == "s"):
                    cost, rest = best(i + 1, initial, 0)
                    ways.append((cost + extra, "K" + rest))
                cost, rest = best(i + 1, follow, 0)
                ways.append((cost + 3 + extra, "R" + rest))
        return min(ways, default=(10**9, ""))

    for i in range(len(rows), 0, -1):  # keeps the recursion shallow
        for last in "-sua":
            best(i, last, 0)
    return best(0, "-", 0)


def expected(rows, damage=True):
    """The contract in plain Python; rows of one turn come in the order of the hash that the operator names."""
    turns, out = defaultdict(list), []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 19
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        order = (turn is not None, turn or 0, hashlib.sha256(f"{role}\0{text}".encode()).digest())
        turns[conv] += [(order, turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    for conv, held in turns.items():
        held.sort(key=lambda r: r[0])
        seen, faults, codes = set(), [0, 0, 0], []
        for _, _, role, text in held:
            bare = text.rstrip(" \t\n\x0b\f\r")
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            if fault is not None:
                faults[fault] += 1
            seen.add((role, text))
            codes.append((role[:1], fault in (0, 1), fault == 2))
        pairs = [a[0] + b[0] for a, b in zip(codes, codes[1:])]
        cost, audit = cheapest(tuple(codes))
        known = {t for _, t, _, _ in held if t is not None}
        last, i, lines = "-", 0, []
        for edit in audit:
            follow = {"-": "u", "s": "u", "u": "a", "a": "u"}[last]
            role, text = ({"u": "user", "a": "assistant"}[follow], "") if edit == "I" else held[i][2:]
            i += edit != "I"
            if edit == "R":
                role = {"u": "user", "a": "assistant"}[follow]
            if edit != "D":
                last = role[:1]
                lines.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in lines))
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        out.append((conv, gaps, *faults, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=str)


def test_solve_against_recursion():
    rng = random.Random(3)
    for _ in range(1500):
        rows = tuple((rng.choice("suuaax"), rng.random() < 0.2, rng.random() < 0.25) for _ in range(rng.randint(0, 12)))
        codes = bytes(repair.INITIAL.get(r.encode(), 0) | (repair.FORCED if f else repair.TRUNCATED if t else 0) for r, f, t in rows)
        assert repair.solve(codes) == cheapest(tuple((r, f, t and not f) for r, f, t in rows)), rows


def test_blocks_make_the_whole():
    rng = random.Random(4)
    for _ in range(200):
        codes = bytes(rng.choice([0, 1, 2, 2, 3, 3, 6, 7, 10, 11]) for _ in range(rng.randint(1, 40)))
        cuts = sorted(rng.choices(range(len(codes) + 1), k=3))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        after, dists = tuple(repair.distances(b"")), []
        for part in reversed(parts):
            dists.insert(0, repair.distances(part, after))
            after = tuple(dists[0][:4])
        out, last = "", repair.NONE
        for k, (part, dist) in enumerate(zip(parts, dists)):
            piece, last = repair.walk(part, dist, last, k == len(parts) - 1)
            out += piece
        assert (dists[0][0], out) == repair.solve(codes)


@pytest.mark.parametrize("block", [1024, 3])
def test_whole_table(spark, block):
    conversations = table(spark, SF, "conversations")
    want = expected([tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()])
    got = rows_of(QUERIES["op12_conversation_repair"](spark, SF) if block == 1024 else repair.audit(conversations, block=block))
    assert got == want and sum(r[6] > 0 for r in got) > 20


def odd():
    rng = random.Random(7)
    texts = ["One.", "Two!", "no end", "", " \n", None, "é?", "Three. \t"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "", "User", None, "tool", "unknown"]), rng.choice(texts)) for c in (1, 2, None, 4) for t in (None, 0, 1, 1, 2, 9, -3) * 3]
    # One conversation holds most rows: much longer than a block, some of its texts many times over.
    rows += [(77, k // 2, rng.choice(["user", "assistant"]), f"text {k % 900 if k % 3 else 5}{'.' if k % 5 else ''}") for k in range(1500)]
    return rows + [(500 + k, 0, "user", "Alone.") for k in range(60)]


@pytest.mark.parametrize("damage", [True, False])
def test_odd_rows(spark, damage):
    rows = odd()
    names = "conv_id long, turn long, role string, text string, block long, key string"
    conversations = spark.createDataFrame([(*r, 1, "x") for r in rows], names).repartition(5)
    want = expected(rows, damage)
    if damage:  # a conversation whose only row was dropped
        gone = {r[0] for r in rows} - {r[0] for r in want}
        want = sorted(want + [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone], key=str)
        assert any(r[7] == "" for r in want)
    assert rows_of(repair.audit(conversations, damage, block=64)) == want
    assert rows_of(repair.audit(conversations, damage, block=7)) == want
    assert repair.audit(conversations.limit(0)).count() == 0


def test_repaired_rows(spark):
    rows = odd()
    conversations = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = defaultdict(list)
    for r in repair.repair(conversations, block=16).collect():
        found[r.conv_id].append((r.part, r.place, r.edit, r.role, r.text))
    for conv, *_, audit, digest in expected(rows, damage=False):
        edits = sorted(found[conv])
        assert "".join(e[2] for e in edits) == audit
        assert hashlib.sha256("\n".join(f"{e[3]}:{e[4]}" for e in edits if e[2] != "D").encode()).hexdigest() == digest


def test_text_ids_and_long_texts(spark):
    rows = [("b", 0, "user", "long " * 200000 + "."), ("b", 1, "assistant", "ok."), (" ", 0, "user", "x."), (None, 0, "user", "x.")]
    conversations = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    assert rows_of(repair.audit(conversations, damage=False)) == expected(rows, damage=False)
