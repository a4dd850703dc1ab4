"""op4: decisions and whole rows against brute force, ties, hot groups, a filter too large to broadcast."""

from __future__ import annotations

import hashlib
import re

import pytest

from pulsegrid.llm import exact_dedup as ed

SF = "/root/testdata/sf0.001"


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    return sorted((i, min(groups[norm(t)]), len(groups[norm(t)]), i == min(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest())
                  for i, t in rows)


ROWS = [(9, "a  b"), (4, "a\tb"), (7, "a b"), (3, "A b"), (5, None), (6, ""), (8, " "), (10, "x " * 40000), (11, "x  " * 40000), (12, "é"), (13, "a b ")]


@pytest.mark.parametrize("hot, broadcast", [(1000, 64 << 20), (2, 64 << 20), (1000, 0)])
def test_small_rows(spark, monkeypatch, hot, broadcast):
    monkeypatch.setattr(ed, "HOT_COPIES", hot)
    monkeypatch.setattr(ed, "BROADCAST_FILTER_BYTES", broadcast)
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("sha", ed.F.lit("clash")).withColumn("size", ed.F.lit(1))
    assert sorted(tuple(r) for r in ed.exact_duplicates(df).collect()) == plain(ROWS)
    kept = ed.drop_exact_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, k, *_ in plain(ROWS) if i == k)


def test_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in ed.op4_exact_dedup(spark, SF).collect()) == plain(docs)


def test_ties_null_ids_and_empty_tables(spark):
    rows = [(2, "t", "p"), (2, "t", "q"), (None, "t", "r"), (None, "u", "s"), (None, "u", "s"), (5, "u", "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = ed.exact_duplicates(df).collect()
    assert sum(r.kept for r in got) == 2 and {r.keep_id for r in got} == {2, 5} and {r.group_size for r in got} == {3}
    assert sorted(r.doc_id for r in ed.drop_exact_duplicates(df).collect()) == [2, 5]
    only_null = df.where("doc_id is null and text = 'u'")
    assert sum(r.kept for r in ed.exact_duplicates(only_null).collect()) == 1
    assert ed.drop_exact_duplicates(only_null).count() == 1
    assert ed.exact_duplicates(df.limit(0)).count() == 0 and ed.drop_exact_duplicates(df.limit(0)).count() == 0


def test_filter_misses_no_repeat(spark):
    keys = spark.range(3000).select(ed.F.unhex(ed.F.sha2(ed.F.concat(ed.F.lit("k"), (ed.F.col("id") % 2900).cast("string")).cast("binary"), 256)).alias("sha"))
    bits = ed.filter_bits(3000)
    probed = ed.with_suspicion(keys, ed.repeated_filter(keys, bits), bits)
    repeated = keys.groupBy("sha").count().where("count > 1").select("sha")
    assert probed.join(repeated, "sha", "left_semi").where("not suspect").count() == 0
    assert probed.where("suspect").count() < 600
