"""op12: the DP against trying every edit, whole conversations against a plain version, the oracle."""

from __future__ import annotations

import random
import re
import zlib
from hashlib import sha256
from itertools import product

import duckdb

from pulsegrid.llm import conversation_repair as cr

SF = "/root/testdata/sf0.001"
LEGAL = re.compile("(s?(ua)+)?")
CODE = {"s": cr.SYSTEM, "u": cr.USER, "a": cr.ASSISTANT}


def every_repair(turns):
    """(cost, audit, roles) of all edits of (initial, must go, cut off), two insertions a gap at most."""
    gaps = ["", "u", "a", "ua", "au", "uu", "aa"]
    for inserted in product(gaps, repeat=len(turns) + 1):
        for edits in product(*(["D"] if gone else ["K", "Ru", "Ra", "D"] for _, gone, _ in turns)):
            roles, audit, cost = "", "", 0
            for k, gap in enumerate(inserted):
                roles, audit, cost = roles + gap, audit + "I" * len(gap), cost + 2 * len(gap)
                if k < len(turns):
                    e, (initial, _, cut) = edits[k], turns[k]
                    audit += e[0]
                    cost += {"K": 0, "R": 2, "D": 3}[e[0]] + (cut and e != "D")
                    roles += {"K": initial, "D": ""}.get(e, e[1:])
            if LEGAL.fullmatch(roles):
                yield cost, audit


def test_cheapest_edits_tries_all():
    rng = random.Random(5)
    cases = [()] + [tuple((rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.choice((1, 2, 2, 3)))) for _ in range(40)]
    for turns in cases:
        code = bytes(CODE.get(i, 0) | cr.MUST_GO * gone | cr.CUT_OFF * cut for i, gone, cut in turns)
        assert cr.cheapest_edits(code) == min(every_repair(turns)), turns


def forward(code):
    """The same minimum by comparing (cost, audit) pairs from the first turn on."""
    best = {0: (0, "")}
    add = lambda p, c, s: (p[0] + c, p[1] + s)
    for t in code:
        spread = dict(best)
        for _ in range(2):
            for q, p in list(spread.items()):
                spread[cr.NEXT[q]] = min(spread.get(cr.NEXT[q], (1 << 60, "")), add(p, 2, "I"))
        best = {}
        for q, p in spread.items():
            ways = [(q, add(p, 3, "D"))]
            if not t & cr.MUST_GO:
                cut = bool(t & cr.CUT_OFF)
                ways.append((cr.NEXT[q], add(p, 2 + cut, "R")))
                if t & 3 == cr.NEXT[q]:
                    ways.append((t & 3, add(p, cut, "K")))
                if t & 3 == cr.SYSTEM and q == 0:
                    ways.append((cr.SYSTEM, add(p, cut, "K")))
            for to, w in ways:
                best[to] = min(best.get(to, (1 << 60, "")), w)
    tail = {0: "", 1: "II", 2: "I", 3: ""}
    return min(add(p, 2 * len(tail[q]), tail[q]) for q, p in best.items())


def test_blocks_give_what_the_whole_gives():
    rng = random.Random(11)
    for n in (0, 1, 5, 40, 200):
        for _ in range(12):
            code = bytes(rng.choice((0, 1, 2, 2, 3, 3)) | rng.choice((0, 0, 0, cr.MUST_GO)) | rng.choice((0, 0, cr.CUT_OFF)) for _ in range(n))
            want = forward(code)
            assert all(cr.cheapest_edits(code, size) == want for size in (1, 3, 16, 1000))


def test_a_very_long_conversation():
    cost, audit = cr.cheapest_edits(bytes([cr.USER, cr.ASSISTANT]) * 100_000 + bytes([cr.USER]))
    assert (cost, len(audit), audit[:3], audit[-2:]) == (2, 200_002, "KKK", "KI")


def key(t):
    return (t[1] is not None, t[1] or 0, t[2], sha256(t[3].encode()).digest())


def plain(rows):
    """Every conversation in plain Python: damage, faults, edits, the repaired text."""
    out = []
    for conv in {r[0] for r in rows}:
        turns = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if fate:
                text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
                turns += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
        turns.sort(key=key)
        seen, faults, code = set(), [], []
        for t in turns:
            body = t[3].strip(" \t\n\x0b\x0c\r")
            fault = "b" if not body else "d" if t[2:] in seen else "t" if body[-1] not in ".!?" else ""
            seen.add(t[2:])
            faults.append(fault)
            code.append(CODE.get(t[2][:1], 0) | (cr.MUST_GO if fault in ("b", "d") else 0) | (cr.CUT_OFF if fault == "t" else 0))
        numbers = [t[1] for t in turns if t[1] is not None]
        cost, audit = forward(code)
        said, at, state = [], 0, 0
        for t in [*turns, None]:
            while audit[at:at + 1] == "I":
                state, at = cr.NEXT[state], at + 1
                said.append(f"{cr.ROLE_OF[state]}:")
            if t and audit[at] != "D":
                state = 1 if audit[at] == "K" and t[2][:1] == "s" else cr.NEXT[state]
                said.append(f"{t[2] if audit[at] == 'K' else cr.ROLE_OF[state]}:{t[3]}")
            at += 1
        out.append((conv, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
                    faults.count("b"), faults.count("d"), faults.count("t"),
                    sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:])),
                    cost, audit, sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=str)


def made_up():
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "tool", "", None, "umpire", "user", "assistant"]
    texts = ["Yes.", "No", " \n", "", None, "Why?  ", "Ünïcode!", "a:b\nc.", "x" * 200_000]
    rows = [(c, rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for c in range(40) for _ in range(rng.randrange(1, 12))]
    rows += [(None, 1, "user", "Hm."), (None, 2, "assistant", "Hm."), (77, None, None, None)]
    rows += [(500, t, "user" if t % 2 else "assistant", f"t{t}.") for t in range(900)]
    return rows + [(501, 1, "user", "again.")] * 300


def test_small_rows(spark, monkeypatch):
    monkeypatch.setattr(cr, "OUT_ROWS", 7)
    monkeypatch.setattr(cr, "BLOCK_TURNS", 16)
    rows = made_up()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("mark", cr.F.lit("clash")).withColumn("kind", cr.F.lit(1))
    assert sorted((tuple(r) for r in cr.repair_summary(df).collect()), key=str) == plain(rows)
    assert cr.repair_summary(df.limit(0)).count() == 0


def test_repaired_turns(spark):
    rows = [("x", 2, "assistant", "Two."), ("x", 1, "system", "One."), ("x", 3, "assistant", "Three"), ("x", 4, "tool", ""),
            ("y", 1, "tool", " "), ("z", 9, "assistant", "Hi.")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    audits = cr.audit_conversations(df)
    got = {r.conv_id: (r.cost, r.audit, r.blank, r.truncated, r.illegal) for r in audits.collect()}
    assert got == {"x": (6, "KRKD", 1, 1, 3), "y": (3, "D", 1, 0, 0), "z": (2, "IK", 0, 0, 0)}
    turns = sorted(tuple(r) for r in cr.repaired_turns(df, audits).collect())
    assert turns == [("x", 1, "K", "system", "One."), ("x", 2, "R", "user", "Two."), ("x", 3, "K", "assistant", "Three"),
                     ("z", 1, "I", "user", ""), ("z", 2, "K", "assistant", "Hi.")]


def test_conversations(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    got = cr.op12_conversation_repair(spark, SF)
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert rows == plain(con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall())
    assert rows == sorted(con.execute(f"SELECT {', '.join(got.columns)} FROM ({cr.OP12_SQL})").fetchall(), key=str)
