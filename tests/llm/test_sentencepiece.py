"""op5 against the library itself, text by text."""

from __future__ import annotations

import hashlib
import random

import pytest

from pulsegrid.llm.sentencepiece_ids import WordTable, encode_decode, model_path, op5_sentencepiece

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path())


ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a\nb\t c", "▁", "▁ ▁x", "x▁y", "  é", "日本 語", "\x00 a", "😀 😀😀",
       "word " * 5000, "x" * 30000, " " * 40 + "end", "<s> </s> <unk>", "<0x41> b"]


def test_table_gives_the_library_ids(library):
    rng = random.Random(7)
    texts = ODD + ["".join(rng.choice(" ▁ab\néÇ\tthe ing") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    table = WordTable(model_path())
    assert table.by_word
    for part in (texts[:200], texts[200:], texts[:50]):
        ids, ends = table.encode(part)
        got = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
        assert got == library.encode(part)
        assert table.decode(ids, ends) == library.decode(library.encode(part))


def test_rows_nulls_and_other_columns(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, None, None), (3, "a", "y"), (3, "a", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = encode_decode(df, model_path()).collect()
    want = [(i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t, _ in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert encode_decode(df.limit(0), model_path()).count() == 0


def test_query_equals_brute_force(spark, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op5_sentencepiece(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for d in docs:
        ids = library.encode(d.text or "")
        want[d.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    assert got == want
