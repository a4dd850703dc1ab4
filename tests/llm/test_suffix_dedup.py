"""op2 against brute force over all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pulsegrid.llm import suffix_dedup as sd

SF = "/root/testdata/sf0.01"


def plain(rows):
    count = Counter()
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        count.update(hash(b[s:s + 200]) for s in range(len(b) - 199))
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, np.int64)
        for s in range(len(b) - 199):
            if count[hash(b[s:s + 200])] > 1:
                gone[s] += 1
                gone[s + 200] -= 1
        mask = np.cumsum(gone)[:-1] > 0
        spans = int((mask & ~np.concatenate([[False], mask[:-1]])).sum()) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~mask]) if len(b) else b""
        out.append((i, len(b), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(df):
    return sorted((tuple(r) for r in sd.remove_repeats(df).select(
        "doc_id", "n_bytes", (sd.F.col("n_bytes") - sd.F.octet_length("kept")), sd.F.size("spans"), sd.F.sha2("kept", 256)).collect()), key=str)


def test_documents(spark):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in sd.op2_suffix_dedup(spark, SF).collect()), key=str)
    assert got == plain(docs)
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("often, window", [(1000, 1 << 18), (3, 1 << 18), (1000, 40)])
def test_overlaps_runs_and_frequent_passages(spark, monkeypatch, often, window):
    monkeypatch.setattr(sd, "OFTEN", often)
    monkeypatch.setattr(sd, "SORT_WINDOWS", window)
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    a, b = word(260), word(230)
    rows = [(i, word(rng.randint(0, 150)) + (a if i % 2 else b) + word(rng.randint(0, 300))) for i in range(14)]
    rows += [(20, a[:210] + a[20:240]), (21, "x" * 1000), (22, "ab" * 150), (23, word(199)), (24, word(300) + a[:199] + word(20))]
    rows += [(25, None), (26, ""), (27, b), (27, b), (None, word(250)), (28, word(200)), (29, a + b + a)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", sd.F.lit("clash"))
    assert run(df) == plain(rows)
    assert sd.remove_repeats(df.limit(0)).count() == 0


def test_very_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sd, "BATCH_BYTES", 700)
    monkeypatch.setattr("pulsegrid.llm.common.BATCH_BYTES", 700)
    rng = random.Random(6)
    long = "".join(rng.choice("abcdef ") for _ in range(9000))
    keys = [sd.anchors(raw, off) for _, _, raw, off in sd._pieces(sd.pa.array([long]))]
    assert len(keys) > 5
    assert sum(int((k[3] - k[2] + 1).sum()) for k in keys) == 9000 - 199


def test_windows_by_digits():
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 99, 4000).astype(np.uint8)
    raw[2500:2800] = raw[100:400]
    starts = np.arange(4000 - 199)
    got = sd.repeated_windows(raw, starts, np.zeros(len(starts), np.int64))
    text = raw.tobytes()
    count = Counter(text[s:s + 200] for s in starts)
    assert got.tolist() == [count[text[s:s + 200]] > 1 for s in starts]
