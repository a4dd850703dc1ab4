"""op11: kept texts against brute force, hot lines, filters too large to broadcast, the oracle."""

from __future__ import annotations

import hashlib

import duckdb
import pytest

from pulsegrid.llm import line_dedup as ld

SF = "/root/testdata/sf0.001"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def key(line):
    k = line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(UPPER, UPPER.lower()))
    return k if len(k) >= 10 else None


def plain(docs):
    rank = lambda i: (i is None, i or 0)
    holders = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            if key(line) is not None:
                holders.setdefault(key(line), set()).add(rank(i))
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) is None or min(holders[key(x)]) == rank(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


A, B = "the same long line", "another line to repeat"
ROWS = [
    (5, f"{A}\nshort\n{B}\r\n{A}"), (3, f"  {A.upper()}\t\nshort\n\n{A}"), (8, B), (9, None), (10, ""), (None, f"{A}\nmine alone, null id"),
    (None, f"{B}\nmine alone, null id"), (None, f"{B}\nmine alone, null id"), (12, "ééééééééé\nÄÄÄÄÄÄÄÄÄÄ"), (13, "ééééééééé\nÄÄÄÄÄÄÄÄÄÄ\nää"),
    (14, "ÄÄÄÄÄÄÄÄÄä"), (15, "\n".join(f"line number {k}" for k in range(50000))), (16, "\n".join(f"Line Number {k}" for k in range(0, 50000, 2)) + "\n" + A),
    (17, "x" * 300000 + "\n" + A), (17, "x" * 300000 + "\n" + B), (18, "x" * 300000), (2, "\x0bline number 7\x0c\x85"), (2, "\x0bline number 7\x0c"),
    (20, "only within\nonly within"), (20, "only within\nonly within"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", ld.F.lit("clash")).withColumn("drops", ld.F.lit(1))


@pytest.mark.parametrize("hot, broadcast, bits, rows", [(1000, 64 << 20, 8, 1 << 16), (2, 64 << 20, 8, 3), (1000, 0, 1, 1000)])
def test_small_rows(spark, monkeypatch, hot, broadcast, bits, rows):
    monkeypatch.setattr(ld, "HOT_LINES", hot)
    monkeypatch.setattr(ld, "BROADCAST_FILTER_BYTES", broadcast)
    monkeypatch.setattr(ld, "BITS_PER_LINE", bits)
    monkeypatch.setattr(ld, "HASH_ROWS", rows)
    assert sorted((tuple(r) for r in ld.dedup_lines(frame(spark)).collect()), key=str) == plain(ROWS)


def test_empty_table_and_other_ids(spark):
    assert ld.dedup_lines(frame(spark).limit(0)).count() == 0
    rows = [("b", A), ("a", A), ("c", "short")]
    named = spark.createDataFrame(rows, "key string, text string")
    got = ld.dedup_lines(named, id_col="key")
    assert got.columns == ["key", "n_lines", "n_dropped", "kept_text"]
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1, 0, A), ("b", 1, 1, ""), ("c", 1, 0, "short")]


def test_filters_keep_every_repeat(spark):
    hashes = spark.range(4000).select(ld.F.xxhash64(ld.F.col("id") % 3500).alias("hash"))
    bits = ld.filter_bits(4000)
    filters = ld.bloom_filters(hashes, bits)
    sizes = filters.agg(ld.F.sum(ld.F.bitmap_count("once")).alias("once"), ld.F.sum(ld.F.bitmap_count("twice")).alias("twice")).first()
    assert 500 <= sizes.twice < sizes.once <= 3500
    repeated = hashes.groupBy("hash").count().where("count > 1").select("hash")
    found = ld.suspected(hashes, filters, bits)
    assert repeated.join(found, "hash", "left_anti").count() == 0
    assert found.distinct().count() < 500 + 3500 * 3500 / bits * 1.5


def test_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = sorted((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in plain(docs))
    got = ld.op11_line_dedup(spark, SF)
    assert sorted(tuple(r) for r in got.collect()) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(con.execute(f"SELECT {', '.join(got.columns)} FROM ({ld.OP11_SQL})").fetchall()) == want
