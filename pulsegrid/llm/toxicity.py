"""Toxicity by a classifier chain of linear models.

The categories stand in a fixed order. Each has its own logistic regression on the words of
the document, and every later one also sees the probabilities of the categories before it. To
train on probabilities like those it will meet, a later model gets out-of-fold predictions: a
training document's earlier probabilities come from models that did not see it.

Training reads a bounded sample of the labelled rows; scoring reads every document whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .common import BATCH_BYTES, bounded_arrow_batches, byte_slices, documents, stage

# Words that make a labelled toxic document an example of a category.
INSULTS = ["clown", "fool", "idiot", "imbecile", "jerk", "liar", "loser", "moron", "scum", "thug"]
CONTEMPT = ["awful", "disgusting", "filthy", "garbage", "pathetic", "repulsive", "stupid", "trash", "vile", "worthless"]

# The chain's order; the last category is the verdict.
CHAIN = ("insult", "contempt", "toxic")

# Labelled rows that training may use; words that the models may use: the MAX_FEATURES that
# lean most to a category, by MIN_LEAN standard errors at
# least, of those in MIN_DOCUMENTS and MIN_SHARE of the training rows at least.
MAX_TRAIN_ROWS = 20_000
MAX_FEATURES = 256
MIN_DOCUMENTS = 5
MIN_SHARE = 0.001
MIN_LEAN = 6.0

FOLDS = 3
RIDGE = 0.02
STEPS = 400
RATE = 0.1

# A document is toxic from this probability on.
THRESHOLD = 0.4


def term_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, first): the term hashes of runs of rows."""
    for a, _, raw, offsets in byte_slices(texts, BATCH_BYTES):
        starts, ends, first = K.words(raw, offsets, terms=True)
        yield a, K.word_hashes(raw, starts, ends), first


def fit_logistic(rows: np.ndarray, cols: np.ndarray, width: int, dense: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Adam over all rows at once.

    ``rows``/``cols`` are the ones of a sparse 0/1 matrix with ``width`` columns, ``dense``
    its further columns. Returns the weights: sparse ones, dense ones, intercept.
    """
    n = len(y)
    extra = np.hstack([dense, np.ones((n, 1))])
    w = np.zeros(width + extra.shape[1])
    mean, var = np.zeros_like(w), np.zeros_like(w)
    ridge = np.full(len(w), RIDGE / max(n, 1))
    ridge[-1] = 0.0
    for step in range(1, STEPS + 1):
        off = (_sigmoid(_margin(w, rows, cols, width, extra)) - y) / max(n, 1)
        grad = np.concatenate([np.bincount(cols, off[rows], minlength=width), extra.T @ off]) + ridge * w
        mean += 0.1 * (grad - mean)
        var += 0.01 * (grad**2 - var)
        w -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.99**step)) + 1e-9)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _margin(w: np.ndarray, rows: np.ndarray, cols: np.ndarray, width: int, extra: np.ndarray) -> np.ndarray:
    return np.bincount(rows, w[cols], minlength=len(extra)) + extra @ w[width:]


def _predict(w: np.ndarray, rows: np.ndarray, cols: np.ndarray, width: int, dense: np.ndarray) -> np.ndarray:
    return _sigmoid(_margin(w, rows, cols, width, np.hstack([dense, np.ones((len(dense), 1))])))


@dataclass
class Chain:
    """A trained chain: at most MAX_FEATURES term hashes and one weight vector a category."""

    names: tuple[str, ...]
    features: np.ndarray
    weights: list[np.ndarray]

    def predict(self, rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
        """(n, categories) probabilities; 0 where nothing was learned."""
        known = np.zeros((n, 0))
        for w in self.weights:
            known = np.hstack([known, _predict(w, rows, cols, len(self.features), known)[:, None]])
        return known if self.weights else np.zeros((n, len(self.names)))


def train_chain(names: tuple[str, ...], features: np.ndarray, rows: np.ndarray, cols: np.ndarray, y: np.ndarray) -> Chain:
    """Fit the models in order; ``y`` is (rows, categories)."""
    n, width = len(y), len(features)
    fold = np.arange(n) % FOLDS
    earlier, weights = np.zeros((n, 0)), []
    for k in range(len(names)):
        weights.append(fit_logistic(rows, cols, width, earlier, y[:, k]))
        unseen = np.zeros(n)
        for f in range(FOLDS):
            learn, number = fold != f, np.cumsum(fold != f) - 1
            mine = learn[rows]
            w = fit_logistic(number[rows[mine]], cols[mine], width, earlier[learn], y[learn, k])
            unseen[~learn] = _predict(w, rows, cols, width, earlier)[~learn]
        earlier = np.hstack([earlier, unseen[:, None]])
    return Chain(names, features, weights)


def _terms(df: DataFrame) -> DataFrame:
    """(row, y, terms): the distinct term hashes of each row's whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, hashes, first in term_hashes(batch.column(2)):
                sets, ends = K.sorted_sets(hashes, first)
                n = len(ends) - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), batch.column(1).slice(a, n),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sets.view(np.int64)))],
                    names=["row", "y", "terms"])

    bounded_arrow_batches(df.sparkSession)
    return df.select("row", "y", "text").mapInArrow(run, "row long, y array<int>, terms array<long>")


def fit_chain(examples: DataFrame, names: tuple[str, ...]) -> Chain:
    """Train on ``examples`` (row long, y array<int> in the order of ``names``, text), which
    the caller has bounded to MAX_TRAIN_ROWS rows. An empty table gives a chain that predicts 0."""
    spark = examples.sparkSession
    table = stage(spark, _terms(examples), "chain-terms")
    labels = table.select("row", "y").orderBy("row").collect()
    if not labels:
        return Chain(names, np.empty(0, np.uint64), [])
    y = np.array([r.y for r in labels], float)
    number = {r.row: i for i, r in enumerate(labels)}
    # How far a term's documents lean to a category, in standard errors.
    words = table.select("row", "y", F.explode("terms").alias("term"))
    counts = words.groupBy("term").agg(
        F.count("*").alias("n"), *(F.sum(F.col("y")[k]).alias(f"n{k}") for k in range(len(names))))
    share = y.mean(0)
    lean = F.array_max(F.array(*(
        (F.col(f"n{k}") - F.col("n") * float(share[k])) / F.sqrt(F.col("n") * float(share[k] * (1 - share[k]) + 1e-9))
        for k in range(len(names)))))
    chosen = [r.term for r in counts.where((F.col("n") >= max(MIN_DOCUMENTS, MIN_SHARE * len(y))) & (lean >= MIN_LEAN))
              .orderBy(F.desc(lean), "term").limit(MAX_FEATURES).select("term").collect()]
    features = np.sort(np.array(chosen, np.int64).view(np.uint64))
    keep = spark.createDataFrame([(t,) for t in chosen], "term long")
    hits = words.select("row", "term").join(F.broadcast(keep), "term").toArrow()
    rows = np.fromiter((number[r] for r in hits["row"].to_pylist()), np.int64, len(hits))
    cols = np.searchsorted(features, np.asarray(hits["term"], np.int64).view(np.uint64))
    order = np.lexsort([cols, rows])  # the same sums in the same order on every run
    return train_chain(names, features, rows[order], cols[order], y)


def score(df: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, one probability a category) for every row of ``df``, from its whole text.
    A null text counts as empty and gets what the intercepts give."""
    bounded_arrow_batches(df.sparkSession)
    narrow = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([narrow.schema["id"], *(T.StructField(c, T.DoubleType()) for c in chain.names)])
    maybe = np.zeros(1 << 16, bool)
    maybe[(chain.features & K.U(0xFFFF)).astype(np.int64)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, hashes, first in term_hashes(batch.column(1)):
                n = len(first) - 1
                at = np.flatnonzero(maybe[(hashes & K.U(0xFFFF)).astype(np.int64)])
                col = np.searchsorted(chain.features, hashes[at])
                same = chain.features[np.minimum(col, len(chain.features) - 1)] == hashes[at] if len(at) else col > 0
                row = np.searchsorted(first, at[same], side="right") - 1
                pairs = np.unique(row * (len(chain.features) + 1) + col[same])
                p = chain.predict(*np.divmod(pairs, len(chain.features) + 1), n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), *(pa.array(p[:, k]) for k in range(len(chain.names)))],
                    names=["id", *chain.names])

    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _mentions(text: Column, words: list[str]) -> Column:
    return text.rlike(r"(?i)\b(" + "|".join(words) + r")\b")


def labelled_examples(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN_ROWS) -> DataFrame:
    """(row, y, text) of at most ``limit`` labelled documents, chosen by the hash of their id.

    A document is an example of insult or contempt when it is labelled toxic and uses a word
    of that list. Null labels teach nothing; of repeated ids one row is taken.
    """
    chosen = (labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id", "toxic").agg(F.max(F.coalesce("text", F.lit(""))).alias("text"))
    toxic = F.col("toxic") == 1
    return one.select(
        F.col("doc_id").cast("long").alias("row"),
        F.array((toxic & _mentions(F.col("text"), INSULTS)).cast("int"),
                (toxic & _mentions(F.col("text"), CONTEMPT)).cast("int"), toxic.cast("int")).alias("y"),
        "text")


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """doc_id, insult, contempt, toxic_score (probabilities), toxic (boolean) of every document."""
    docs = documents(spark, sf_dir)
    chain = fit_chain(labelled_examples(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), CHAIN)
    return score(docs, chain).select(
        "doc_id", "insult", "contempt", F.col("toxic").alias("toxic_score"), (F.col("toxic") >= THRESHOLD).alias("toxic"))
