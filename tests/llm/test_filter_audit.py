"""op13: every order applied to the rows one filter after another, and the DuckDB oracle."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest

from pulsegrid.llm import filter_audit as fa

SF = "/root/testdata/sf0.001"


def failed(text, copy):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    caps = sum("A" <= c <= "Z" for c in text)
    return {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * caps > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": copy}


def plain(docs, labels):
    """Rows really go through the filters, order by order."""
    key = lambda i: (i is None, i or 0)
    least = {}
    for i, t, _ in docs:
        least[t or ""] = min(least.get(t or "", (True, 0)), key(i))
    rows = [(p or "", failed(t or "", key(i) > least[t or ""]),
             any(j == i and q == 1 for j, q, _ in labels if j is not None),
             any(j == i and x == 1 for j, _, x in labels if j is not None)) for i, t, p in docs]
    out, removals = [], Counter()
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                removals[part, f] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), sum(r[1][f] for r in mine) - len(gone),
                            sum(r[1][f] and sum(r[1].values()) == 1 for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)))
    return sorted((*r, removals[r[0], r[1][r[2] - 1]]) for r in out)


LONG = " ".join(f"w{i}" for i in range(150))
DOCS = [
    (5, LONG, "en"), (3, LONG, "de"), (None, LONG, "de"), (None, LONG, None), (3, LONG, "de"), (7, None, "en"), (8, "", ""),
    (9, " \n", "en"), (10, "A$ b", "en"), (11, LONG.upper(), "en"), (12, LONG + " #", "en"), (13, "x " * 200, None),
    (14, LONG + "   %", "fr"), (15, "y " * 60000 + LONG, "fr"), (16, LONG.replace(" ", "\x0b") + " é", "fr"),
]
LABELS = [(3, 1, 0), (5, 1, 1), (5, 0, 1), (None, 1, 1), (10, None, 1), (11, 1, None), (99, 1, 1), (13, 1, 1), (13, 1, 1)]


def frame(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("mask", fa.F.lit("clash")).withColumn("part", fa.F.lit(1))
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", fa.F.lit("clash"))


def test_small_rows(spark):
    got = sorted(tuple(r) for r in fa.audit_filters(*frame(spark, DOCS, LABELS)).collect())
    assert got == plain(DOCS, LABELS)


def test_empty_tables(spark):
    docs, labels = frame(spark, DOCS, LABELS)
    assert fa.audit_filters(docs.limit(0), labels).count() == 0
    assert sorted(tuple(r) for r in fa.audit_filters(docs, labels.limit(0)).collect()) == plain(DOCS, [])


def test_gray_walk_is_the_sum_over_cells():
    cell = [(m, m * 7 % 11, m % 3, m % 2) for m in range(fa.SETS)]
    for s, state in enumerate(fa.survivors(cell)):
        assert state == tuple(sum(c[k] for c in cell if not c[0] & s) for k in (1, 2, 3))


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_documents(spark, tables):
    got = fa.op13_filter_audit(spark, SF)
    rows = sorted(tuple(r) for r in got.collect())
    names = ", ".join(got.columns)
    assert rows == sorted(tables.execute(f"SELECT {names} FROM ({fa.OP13_SQL})").fetchall())
    docs = tables.execute("SELECT doc_id, text, lang FROM documents").fetchall()
    assert rows == plain(docs, tables.execute("SELECT doc_id, quality, toxic FROM labels").fetchall())
