"""op8: targets, draws and permutations by hand; the mix against a plain recount."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from pulsegrid.llm import mixing as mx

SF = "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights, total, most=mx.MOST):
    """Share, cap, reshare what the capped leave, until none is above."""
    capped = set()
    while True:
        rest = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(most * sizes[i] for i in capped)
        unit = left / sum(weights[i] for i in rest) if rest else Fraction(0)
        above = [i for i in rest if weights[i] * unit > most * sizes[i]]
        if not above:
            return [Fraction(most * sizes[i]) if i in capped else weights[i] * unit for i in range(len(sizes))]
        capped.update(above)


def mix_targets(sizes):
    return plain_targets(sizes, [mx.WEIGHTS[i % 3] for i in range(len(sizes))], mx.SHARE * sum(sizes))


@pytest.mark.parametrize("sizes", [[100, 100, 100], [10, 0, 90], [0, 0], [1, 1, 1, 1000], [130, 90, 5, 64, 65, 128, 3, 1, 300], [7, 2, 1, 40, 1, 500, 3, 9, 10**9]])
def test_targets_are_reshared_until_none_is_above(spark, sizes):
    table = spark.createDataFrame([(f"{i:02}", n) for i, n in enumerate(sizes)], "of string, words_in long")
    got = sorted(mx._sources(table, sum(sizes)).collect())
    want = mix_targets(sizes)
    assert [r.target for r in got] == [float(t) for t in want]
    assert [r.want for r in got] == [round(t) for t in want]


def test_draws_add_up():
    for n, shards in ((1000, 7), (3, 7), (0, 7), (7, 7), (250, 1)):
        shard, counts = mx.draw_counts(n, shards, 5)
        assert counts.sum() == n and (counts > 0).all() and len(set(shard)) == len(shard) and set(shard) <= set(range(shards))
        assert [x.tolist() for x in mx.draw_counts(n, shards, 5)] == [shard.tolist(), counts.tolist()]


@pytest.mark.parametrize("shard_words, draws", [(1 << 22, 1 << 18), (300, 2)])
def test_every_source_comes_to_its_target(spark, monkeypatch, shard_words, draws):
    monkeypatch.setattr(mx, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(mx, "TASK_DRAWS", draws)
    sizes = [130, 90, 5, 64, 65, 128, 3, 1, 3000]
    rows = [(10 * i + k, " ".join(["w"] * w), f"s{i}", 1) for i, n in enumerate(sizes) for k, w in enumerate((n // 3, n - n // 3 - n // 2, n // 2))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    mix = mx.plan_mix(df, ["doc_id"])
    got = mix.rows.join(mix.taken(), "row", "left").fillna(0, ["words"]).collect()
    assert all(r.words <= 2 * r["size"] for r in got)
    for i, t in enumerate(mix_targets(sizes)):
        assert sum(r.words for r in got if r.number == i) == round(t)
    in_blocks = mix.blocks().groupBy("shard", "slot").agg(mx.F.sum("words").alias("n")).collect()
    assert sum(r.n for r in in_blocks) == sum(r.words for r in got) and max(r.n for r in in_blocks) <= mx.BLOCK_WORDS


@pytest.mark.parametrize("broadcast", [1 << 16, 0])
def test_many_sources_and_copies_of_null(spark, monkeypatch, broadcast):
    monkeypatch.setattr(mx, "BROADCAST_SOURCES", broadcast)
    rows = [(i, f"a b c d {i}", f"domain{i % 12000}") for i in range(15000)] + [(None, "same words here", None)] * 500 + [(None, f"x {i}", None) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mx.plan_mix(df, [])
    assert mix.sources.count() == 12001
    got = mix.rows.join(mix.taken(), "row", "left").groupBy("number").agg(mx.F.sum("words").alias("taken")).join(mix.sources, "number").collect()
    assert len(got) == 12001 and all((r.taken or 0) == r.want and abs(r.want - r.target) <= 0.5 for r in got)


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64, 1000])
def test_permutation(size):
    a, b = (mx.permuted(np.arange(size), size, key) for key in (5, 6))
    assert sorted(a) == sorted(b) == list(range(size))
    assert size < 17 or (a != b).any()


def test_mix_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in mx.op8_mixing(spark, SF).collect()}
    size = {d.doc_id: len(WORDS.findall(d.text or "")) for d in docs.collect()}
    assert {k: r.size for k, r in got.items()} == size
    of = {d.doc_id: d.source for d in docs.collect()}
    totals, taken = Counter(), Counter()
    for k, r in got.items():
        totals[of[k]] += size[k]
        taken[of[k]] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    names = sorted(totals)
    for n, t in zip(names, mix_targets([totals[n] for n in names]), strict=True):
        assert taken[n] == round(t)
    assert all(r.source_size == totals[of[k]] for k, r in got.items())
    assert {k: r.taken for k, r in got.items()} == {r.doc_id: r.taken for r in mx.op8_mixing(spark, SF).collect()}


def test_mixed_texts_are_the_taken_words(spark):
    rows = [(1, "a b  c\td", "x", 9), (2, None, "x", 0), (3, "e " * 300, None, 600), (4, "", "", 0), (5, "f g", "z", 3),
            (5, "f g", "z", 3), (None, "h", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").withColumn("row", mx.F.lit("clash"))
    mix = mx.plan_mix(df, ["doc_id"])
    taken = {r.id: r.words for r in mix.rows.join(mix.taken(), "row").collect() if r.id != 5}
    out = mx.mixed_documents(df).collect()
    assert out[0].asDict().keys() == dict.fromkeys(df.columns).keys()
    by = defaultdict(int)
    for r in out:
        assert r.n_chars == len(r.text) and r.row == "clash"
        by[r.doc_id] += len(r.text.split())
    by.pop(5, None)
    assert dict(by) == taken
    per_block = mix.blocks().groupBy("shard", "slot").agg(mx.F.sum("words").alias("n")).collect()
    assert all(r.n <= mx.BLOCK_WORDS for r in per_block) and sum(r.n for r in per_block) == mix.taken().agg(mx.F.sum("words")).first()[0]
    assert mx.mixed_documents(df.limit(0)).count() == 0
