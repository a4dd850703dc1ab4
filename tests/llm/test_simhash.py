"""op1 against a plain Python SimHash, and the search against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
import xxhash

from pulsegrid.llm import simhash as sh

SF = "/root/testdata/sf0.001"
ALL = (1 << 64) - 1


def plain_print(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    hashed = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    votes, n = [0] * 64, 0
    for i in range(max(len(hashed) - 4, 1) if hashed else 0):
        h = 42
        for x in hashed[i:i + 5]:
            h = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), h)
        n += 1
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > n)


def expected(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        a, b, c = map(plain_print, (text, changed, after))
        out[i] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), f"{a:016x}", f"{b:016x}",
                  1 - bin(a ^ b).count("1") / 64, 1 - bin(a ^ c).count("1") / 64)
    return out


def near(prints, i):
    return sum(bin(prints[i] ^ p).count("1") <= sh.RADIUS for j, p in prints.items() if j != i)


@pytest.mark.parametrize("bucket", [sh.BUCKET_BYTES, 30_000])
def test_query_equals_plain_python(spark, monkeypatch, bucket):
    monkeypatch.setattr(sh, "BUCKET_BYTES", bucket)
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in sh.op1_simhash(spark, SF).collect()}
    want = expected(docs)
    assert len(got) == len(docs) == len(want)
    assert {k: v[:6] for k, v in got.items()} == want
    prints = {k: int(v[2], 16) for k, v in want.items()}
    assert {k: v[6] for k, v in got.items()} == {k: near(prints, k) if k % 50 == 0 else None for k in want}


def test_odd_rows(spark, tmp_path):
    rows = [(7, None), (1, ""), (-5, "é" * 9), (3, "a b c"), (900, "long " * 3000), (12, "A  b\tc"), (4, "日本 語")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", sh.F.lit("clash"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:7] for r in sh.op1_simhash(spark, str(tmp_path)).collect()}
    assert got == expected(rows)
    assert got[3][2] == got[12][2]
    repeated = df.unionByName(df.where("doc_id in (3, 900)")).unionByName(spark.createDataFrame(
        [(None, "x y"), (None, None)], "doc_id long, text string").withColumn("bucket", sh.F.lit("")))
    repeated.write.parquet(f"{tmp_path}/r/documents.parquet")
    again = sh.op1_simhash(spark, f"{tmp_path}/r").collect()
    assert len(again) == 11 and {r.fingerprint for r in again if r.doc_id == 3} == {got[3][2]}
    df.limit(0).write.parquet(f"{tmp_path}/e/documents.parquet")
    assert sh.op1_simhash(spark, f"{tmp_path}/e").count() == 0


@pytest.mark.parametrize("rows", [10, 1 << 22, 1 << 33])
def test_block_tables_miss_nothing(spark, rows):
    rng = random.Random(rows)
    base = [rng.getrandbits(64) for _ in range(40)]
    flip = lambda x, k: x ^ sum(1 << b for b in rng.sample(range(64), k))
    prints = sorted({flip(x, k) for x in base for k in (0, 1, 2, 3, 4, 3)})
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "fingerprint long")
    got = sorted((r.query & ALL, r.found & ALL) for r in sh.near_fingerprints(df, df, rows).collect())
    assert got == sorted((a, b) for a in prints for b in prints if bin(a ^ b).count("1") <= 3)


@pytest.mark.parametrize("rows", [10, 1 << 24])
def test_search_misses_nothing_within_the_radius(spark, rows):
    rng = random.Random(rows)
    flip = lambda x, k: x ^ sum(1 << b for b in rng.sample(range(64), k))
    prints = sorted({flip(x, k) for x in [rng.getrandbits(64) for _ in range(6)] for k in (0, 1, 5, 8, 10, 11, 11, 11, 12, 13)})
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long")
    got = sorted((r.query & ALL, r.found & ALL) for r in sh.near_fingerprints(df, df, rows, sh.RADIUS).collect())
    assert got == sorted((a, b) for a in prints for b in prints if bin(a ^ b).count("1") <= sh.RADIUS)


def test_recall_of_edited_copies(spark):
    """Shares of pairs found, of texts of 404 words whose shingle sets have the given Jaccard."""
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(10 ** 9)}"
    found = {}
    for jaccard in (0.75, 0.85, 0.95):
        kept = round(400 * 2 * jaccard / (1 + jaccard))  # shingles in common, of 400 each
        rows = []
        for i in range(150):
            text = [word() for _ in range(404)]
            rows.append((i, " ".join(text), " ".join(text[:kept + 4] + [word() for _ in range(400 - kept)])))
        df = spark.createDataFrame(rows, "id long, a string, b string")
        prints = sh.fingerprints(df, ["id"], {"x": sh.F.col("a"), "y": sh.F.col("b")}).collect()
        found[jaccard] = sum(bin((r.x ^ r.y) & ALL).count("1") <= sh.RADIUS for r in prints) / len(prints)
    print(found)
    assert found[0.75] > 0.45 and found[0.85] > 0.8 and found[0.95] > 0.98
