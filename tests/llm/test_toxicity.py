"""op7: the linear fit, the chain, held-out labels, odd rows."""

from __future__ import annotations

import numpy as np

from pulsegrid.llm import toxicity as tox

SF = "/root/testdata/sf0.1"


def test_fit_finds_the_telling_column():
    rng = np.random.default_rng(3)
    x = rng.random((600, 8)) < 0.3
    rows, cols = np.nonzero(x)
    w = tox.fit_logistic(rows, cols, 8, np.zeros((600, 0)), x[:, 2].astype(float))
    assert w[2] > 3 and np.abs(np.delete(w[:8], 2)).max() < 1.5 and w[-1] < 0


def test_later_model_reads_the_earlier_probability():
    rng = np.random.default_rng(4)
    x = rng.random((900, 5)) < 0.4
    rows, cols = np.nonzero(x)
    y = np.stack([x[:, 0], x[:, 0]], 1).astype(float)
    chain = tox.train_chain(("a", "b"), np.arange(5, dtype=np.uint64), rows, cols, y)
    assert len(chain.weights[0]) == 6 and len(chain.weights[1]) == 7
    assert chain.weights[1][5] > 0.5
    assert ((chain.predict(rows, cols, 900) > 0.5) == y.astype(bool)).all()


def test_unseen_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    test = labels.where("crc32(cast(doc_id as string)) % 5 = 0")
    chain = tox.fit_chain(tox.labelled_examples(docs, labels.join(test, "doc_id", "left_anti")), tox.CHAIN)
    test = test.join(docs.select("doc_id", tox._mentions(tox.F.col("text"), tox.INSULTS + tox.CONTEMPT).alias("says")), "doc_id")
    got = tox.score(docs.join(test.select("doc_id"), "doc_id"), chain).withColumnRenamed("toxic", "p").join(test, "doc_id").collect()
    assert len(got) > 500
    # A sixth of the labels is noise: the document has no toxic word at all. Those say nothing.
    caught = [r.p >= tox.THRESHOLD for r in got if r.toxic and r.says]
    false = [r.p >= tox.THRESHOLD for r in got if not r.toxic]
    assert np.mean(caught) > 0.97 and np.mean(false) < 0.005


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "you idiot", "a"), (2, None, None), (None, "fine words", "b"), (3, "", ""), (3, "", "")],
        "doc_id long, text string, insult string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    chain = tox.fit_chain(tox.labelled_examples(docs, none), tox.CHAIN)
    got = tox.score(docs, chain).collect()
    assert len(got) == 5 and {r.toxic for r in got} == {0.0}
    some = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (9, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    chain = tox.fit_chain(tox.labelled_examples(docs, some), tox.CHAIN)
    assert tox.score(docs, chain).count() == 5 and tox.score(docs.limit(0), chain).count() == 0
