"""op6: counts and base score against plain counting, the mixture against a plain model."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pulsegrid.llm import lm_score as lm

SF = "/root/testdata/sf0.01"
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def tokens_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return SPLIT.findall(low) + [None]


def residue(i):
    return zlib.crc32(str(i).encode()) % 10


def model(rows):
    words, pairs = Counter(), Counter()
    for _, text in rows:
        before = None
        for w in tokens_of(text):
            words[w] += 1
            pairs[before, w] += 1
            before = w
    return words, pairs, sum(words.values())


def estimates(text, counts):
    words, pairs, n = counts
    before = None
    for w in tokens_of(text):
        c = words[before]
        yield (0 if not c else min(1 + int(math.log2(c)), lm.CONTEXTS - 1)), (pairs[before, w] / c if c else 0.0), words[w] / max(n, 1)
        before = w


def plain(rows):
    train = [r for r in rows if residue(r[0]) != 0]
    core = model([r for r in train if residue(r[0]) != 1])
    cells = [(b, 1, p, q) for i, t in train if residue(i) == 1 for b, p, q in estimates(t, core)]
    weights = lm.learn_weights(cells, 1 / (len(core[0]) + 1))
    full = model(train)
    n, v = full[2], len(full[0])
    out = {}
    for i, text in rows:
        toks = tokens_of(text)
        base = sum(math.log10((full[0][w] + 0.1) / (n + 0.1 * (v + 1))) for w in toks)
        score = sum(math.log10(weights[b] @ [p, q, 1 / (v + 1)]) for b, p, q in estimates(text, full))
        out[i] = (residue(i) == 0, len(toks), sum(full[0][w] > 0 for w in toks), n, base, score)
    return out


def check(got, want):
    assert {k: v[:4] for k, v in got.items()} == {k: v[:4] for k, v in want.items()}
    for k in want:
        assert got[k][4] == pytest.approx(want[k][4], rel=1e-9)
        assert got[k][5] == pytest.approx(want[k][5], rel=0.02, abs=0.3)  # the weights come from cells


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_BYTES", 1 << 17)
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in lm.op6_lm_score(spark, SF).collect()}
    check(got, plain(docs))
    tested = [v for v in got.values() if v[0]]
    assert sum(v[5] for v in tested) > sum(v[4] for v in tested)


def test_small_chunks_and_odd_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 60)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 40)
    rows = [(i, t) for i, t in enumerate(["a b c a b", "A B", None, "", "a b c d", "x " * 500, "é ß", "a b", "c\td\x0be"] * 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("chunk", lm.F.lit("clash"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in lm.op6_lm_score(spark, str(tmp_path)).collect()}
    check(got, plain(rows))
    df.unionByName(df.where("doc_id < 3")).unionByName(spark.createDataFrame([(None, "a", "")], "doc_id long, text string, chunk string")) \
        .write.parquet(f"{tmp_path}/r/documents.parquet")
    assert lm.op6_lm_score(spark, f"{tmp_path}/r").count() == len(rows) + 4
    df.limit(0).write.parquet(f"{tmp_path}/e/documents.parquet")
    assert lm.op6_lm_score(spark, f"{tmp_path}/e").count() == 0


def test_weights_of_a_known_mixture():
    rng = np.random.default_rng(2)
    p, q, u = rng.random(4000) * 0.5, rng.random(4000) * 0.1, 0.001
    w = lm.learn_weights([(5, 1, a, 0.0) for a in p] + [(3, 1, 0.0, b) for b in q], u)
    assert w[5, 0] > 0.98 and w[3, 1] > 0.9 and w.sum(1) == pytest.approx(1)
    assert lm.learn_weights([], 1.0).shape == (lm.CONTEXTS, 3)


def test_packing():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 999, np.uint64))
    assert (lm.unpack_sorted(lm.pack_sorted(values), 999) == values).all()
    assert lm.unpack(lm.pack(np.empty(0, np.uint32)), 0, np.uint32).tolist() == []
