"""op3: grams against plain counting, held-out accuracy, odd rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np

from pulsegrid.llm import language_id as lid

SF = "/root/testdata/sf0.01"


def plain_grams(text):
    s = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    found = Counter(s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1))
    return Counter({g: k for g, k in found.items() if g.strip()})


def spelled(code):
    parts = [(int(code) >> s) & ((1 << 21) - 1) for s in (42, 21, 0)]
    return "".join(" " if p == 1 else chr(p - 2) for p in parts if p)


TEXTS = ["", " ", "a", "Éa b", "12 3", "ab12cd  EF", "日本語 text", "x" * 50, "l'été, c'est\nbien"]


def test_grams_equal_plain_counting():
    grams, first, letters = lid.gram_runs(TEXTS)
    for i, text in enumerate(TEXTS):
        got = Counter(spelled(c) for c in lid.codes(grams[first[i]:first[i + 1]], letters))
        assert got == plain_grams(text)


def test_most_frequent_breaks_ties_by_gram():
    grams = np.array([5, 3, 3, 9, 9, 1], np.uint32)
    assert lid._most_frequent(grams).tolist() == [3, 9, 1, 5]


def test_profiles_and_distance_by_hand():
    p = lid.Profiles([("xx", 7, 0), ("xx", 9, 1), ("yy", 9, 0)])
    lang, score = p.predict(np.array([9, 4], np.uint64))  # xx: 1 + 300, yy: 0 + 300
    assert lang == "yy" and score == 1 - 300 / 600
    assert p.predict(np.array([4], np.uint64)) == ("xx", 0.0)  # a tie goes to the first name


def test_held_out_accuracy_and_whole_result(spark):
    got = lid.op3_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = got.join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert len(rows) == docs.count() == got.count()
    tested = [r for r in rows if r.held_out]
    assert 250 < len(tested) < 420
    assert sum(r.lang == r.lang_pred for r in tested) / len(tested) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def plain_top(counts):
    """The most frequent grams, ties by code: a letter by its number, a break before letters, nothing first of all."""
    code = lambda g: tuple(1 if c == " " else ord(c) + 2 for c in g) + (0,) * (3 - len(g))
    return [g for g, _ in sorted(counts.items(), key=lambda kv: (-kv[1], code(kv[0])))[:lid.PROFILE]]


def test_predictions_against_plain_profiles(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    counts = {}
    for d in docs:
        if zlib.crc32(str(d.doc_id).encode()) % 3 != 1 and d.lang is not None:
            counts.setdefault(d.lang, Counter()).update(plain_grams(d.text or ""))
    ranks = {lang: {g: r for r, g in enumerate(plain_top(c))} for lang, c in counts.items()}
    got = {r.doc_id: r for r in lid.op3_language_id(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for d in docs:
        top = plain_top(plain_grams(d.text or ""))
        far = {lang: sum(abs(rank[g] - i) if g in rank else lid.PROFILE for i, g in enumerate(top)) for lang, rank in ranks.items()}
        best = min(sorted(far), key=far.get)
        assert got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 3 == 1)
        assert got[d.doc_id].lang_pred == (best if top else "und")
        assert abs(got[d.doc_id].score - (1 - far[best] / (lid.PROFILE * len(top)) if top else 0)) < 1e-12


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (4, "le chat et le chien", "fr"), (None, None, None),
            (2, "", "en"), (3, "123 !!", None), (6, "le chat", None), (6, "le chat", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", lid.F.lit("x"))
    got = lid.identify(df, lid.learn_profiles(df)).collect()
    pred = {(r.doc_id, r.lang_pred) for r in got}
    assert len(got) == 7
    assert pred == {(1, "en"), (4, "fr"), (None, "und"), (2, "und"), (3, "und"), (6, "fr")}
    empty = df.limit(0)
    assert lid.identify(empty, lid.learn_profiles(empty)).count() == 0
    assert {r.lang_pred for r in lid.identify(df, lid.learn_profiles(empty)).collect()} == {"und"}


def test_short_texts_and_large_alphabets_stay(spark):
    rng = random.Random(5)
    signs = [chr(0x4E00 + i) for i in range(3000)]
    chinese = lambda n: "".join(rng.choices(signs, [1 / (i + 1) for i in range(3000)], k=n))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang").where("lang = 'en'")
    taught = docs.unionByName(spark.createDataFrame([(chinese(400), "zh") for _ in range(50)], docs.schema))
    model = lid.learn_profiles(taught)
    least = lid.least_closeness(taught, model)
    clean = ["from", "Quick fix for login bug", "x", "Øre", *(chinese(n) for n in (1, 2, 50, 200) for _ in range(30)), chr(0x9FA5)]
    odd = ["", "12 !!", None, "Все люди рождаются", "これは"]
    wide = ["\uff34\uff48\uff45 \uff43\uff41\uff54", "ª"]  # full-width and raised letters are Latin
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(clean + wide + odd)], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.lang for r in lid.keep_identified(df, model, least).collect()}
    assert set(kept) == set(range(len(clean + wide))) and set(kept.values()) <= {"en", "zh"}
    found = {r.doc_id: r.lang_pred for r in lid.identify(df, model).collect()}
    assert [t for i, t in enumerate(clean + wide + odd) if found[i] == "und"] == ["", "12 !!", None]
    assert all(kept[i] == found[i] for i in kept)


def test_far_texts_go_and_null_languages_are_filled(spark, monkeypatch):
    monkeypatch.setattr(lid, "LEAST_SEEN", 5)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = lid.learn_profiles(docs)
    least = lid.least_closeness(docs, model)
    assert least.count() > 4 and least.where("least <= 0 or least > 1").count() == 0
    rng = random.Random(3)
    noise = "".join(rng.choice("qxzjkw") for _ in range(1500))
    odd = spark.createDataFrame([(-1, noise, "en"), (-2, noise, None), (-3, "the same text as before and the rest", None)], docs.schema)
    odd = odd.withColumn("lang", lid.F.col("lang")).unionByName(docs.withColumn("lang", lid.F.when(lid.F.col("doc_id") % 2 == 0, lid.F.col("lang"))))
    kept = {r.doc_id: r for r in lid.keep_identified(odd, model, least).collect()}
    assert -1 not in kept and -2 not in kept and kept[-3].lang == "en"
    labels = {r.doc_id: r for r in docs.collect()}
    assert set(kept) - {-3} == set(labels) and all(kept[i].text == labels[i].text for i in labels)
    assert all(kept[i].lang == labels[i].lang for i in labels if i % 2 == 0)
    assert sum(kept[i].lang == labels[i].lang for i in labels if i % 2) > 0.97 * sum(1 for i in labels if i % 2)


def test_repeats_clashes_and_a_very_long_text(spark):
    rows = [(1, "the cat and the dog " * 60000, "en"), (2, "le chat et le chien", "fr"), (2, "le chat et le chien", None), (2, "12", "fr"), (2, "12", "fr"), (None, None, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("whole", lid.F.lit("x")).withColumn("_lang", lid.F.lit(3))
    model = lid.learn_profiles(df)
    kept = lid.keep_identified(df, model, lid.least_closeness(df, model))
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.lang, r.whole, r["_lang"]) for r in kept.collect()) == [(1, "en", "x", 3), (2, "fr", "x", 3), (2, "fr", "x", 3)]
    assert lid.keep_identified(df.limit(0), model, lid.least_closeness(df, model)).count() == 0
    many = spark.createDataFrame([(i, f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} abc", f"l{i}") for i in range(1500)], "doc_id long, text string, lang string")
    assert len(lid.learn_profiles(many).langs) == 1500
