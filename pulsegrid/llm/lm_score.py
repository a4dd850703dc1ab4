"""LM scoring: a bigram model by deleted interpolation.

The probability of a word after another is a mixture of three maximum-likelihood estimates:
of the pair, of the word, and the uniform one over all words and one unknown. The mixture
weights depend on how often the context was seen, by powers of two. They are learned on one
tenth of the training documents, deleted from the counts for that, by expectation-maximisation;
the final counts are those of all training documents.

Texts are read once and kept as chunks: the sorted hashes of a chunk's words, and its texts as
numbers of words. Each chunk sends the sorted hashes of its distinct words and pairs, with
counts, to buckets by the hash, packed. A bucket sums them and answers each chunk in the order
it was asked in. A frequent pair is one entry a chunk, so no bucket gathers a hot key.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .common import bounded_arrow_batches, byte_slices, documents, id_residue, stage

# Text of a chunk. It grows with the square root of very large inputs, up to the most, so that
# chunks times buckets stays in proportion.
CHUNK_BYTES = 8 << 20
MOST_CHUNK_BYTES = 64 << 20
PLAIN_BYTES = 16 << 30

# Text for each bucket of hashes.
BUCKET_BYTES = 8 << 20

# Roles: scored only; deleted to learn the weights; the rest of training.
HELD_OUT, DELETED, TRAIN = 0, 1, 2

# Context buckets: 0 for an unseen context, else 1 + log2 of its count, at most CONTEXTS - 1.
CONTEXTS = 24
EM_ROUNDS = 60

# Cells of the table that the weights are learned from: quarter powers of two of an estimate.
CELL = 4

END = K.U(0x9FB21C651E98DF25)  # stands for the end of a text, and before its first word


# --- Packed arrays ------------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(data, decompressed_size=n * width, codec="zstd", asbytes=True) if n else b""
    planes = np.frombuffer(raw, np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind) if n else np.empty(0, kind)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=K.U(0)))


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n, np.uint64), dtype=np.uint64)


# --- Chunks ---------------------------------------------------------------------------------


def _chunks(limit: int):
    """Task function: (id, role, text) -> chunks (chunk, role, ids, sizes, n_words, words, numbers)."""
    def flush(role: int, parts: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        sizes = np.concatenate([p[1] for p in parts])
        words, numbers = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
        ids = pa.concat_arrays([p[0] for p in parts])
        one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
        return pa.RecordBatch.from_arrays(
            [pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([role], pa.int32()), one(ids), one(pa.array(sizes.astype(np.int32))),
             pa.array([len(words)], pa.int32()), pa.array([pack_sorted(words)], pa.binary()), pa.array([pack(numbers.astype(np.uint32))], pa.binary())],
            names=["chunk", "role", "ids", "sizes", "n_words", "words", "numbers"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {HELD_OUT: [], DELETED: [], TRAIN: []}
        size = dict.fromkeys(held, 0)
        for batch in batches:
            roles = np.asarray(batch.column(1))
            for a, b, raw, offsets in byte_slices(batch.column(2)):
                starts, ends, first = K.words(raw, offsets)
                hashes = K.word_hashes(raw, starts, ends)
                tokens = np.insert(hashes, first[1:], END)  # each text ends with one more
                sizes = np.diff(first) + 1
                own = np.repeat(roles[a:b], sizes)
                for role in held:
                    rows = np.flatnonzero(roles[a:b] == role)
                    if len(rows):
                        held[role].append((batch.column(0).take(pa.array(rows + a)), sizes[rows], tokens[own == role]))
                        size[role] += int((offsets[rows + 1] - offsets[rows]).sum())
                    if size[role] >= limit:
                        yield flush(role, held[role])
                        held[role], size[role] = [], 0
        for role, parts in held.items():
            if parts:
                yield flush(role, parts)

    return run


class Chunk:
    """A chunk as arrays: token hashes, the one before each, and the distinct pairs."""

    def __init__(self, row: dict):
        n = sum(row["sizes"])
        self.sizes = np.array(row["sizes"], np.int64)
        self.words = unpack_sorted(row["words"], row["n_words"])
        self.numbers = unpack(row["numbers"], n, np.uint32).astype(np.int64)
        before = np.empty(n, np.int64)
        before[1:] = self.numbers[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = np.searchsorted(self.words, END)
        self.before = before
        code = self.words * K.U(0xD6E8FEB86659FD93)
        self.pair_of_token = K.mix(K.mix(code)[before] + self.words[self.numbers])


def _asks(bits: int):
    """Task function: chunks -> (kind, bucket, chunk, role, n, hashes, counts), a row for each
    bucket that a chunk has hashes for. Kind 0 is words, 1 is pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row)
                word_counts = np.bincount(c.numbers, minlength=len(c.words))
                for kind, (values, counts) in enumerate(((c.words, word_counts), np.unique(c.pair_of_token, return_counts=True))):
                    buckets, first = np.unique(values >> K.U(64 - bits), return_index=True)
                    edge = np.append(first, len(values))
                    spans = list(zip(edge[:-1].tolist(), edge[1:].tolist()))
                    k = len(buckets)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * k, pa.int32()), pa.array(buckets.astype(np.int64)), pa.array([row["chunk"]] * k, pa.int64()),
                         pa.array([row["role"]] * k, pa.int32()), pa.array([b - a for a, b in spans], pa.int32()),
                         pa.array([pack_sorted(values[a:b]) for a, b in spans], pa.binary()),
                         pa.array([pack(counts[a:b].astype(np.uint32)) for a, b in spans], pa.binary())],
                        names=["kind", "bucket", "chunk", "role", "n", "hashes", "counts"])

    return run


def _answers(table: pa.Table) -> pa.Table:
    """One bucket: sum the counts of each hash, and answer every chunk in its own order: counts
    over all training, and for deleted chunks also those without the deleted documents.
    One more row, without chunk, has the number of tokens and of distinct hashes of both."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    sizes = np.array([r["n"] for r in rows])
    hashes = np.concatenate([unpack_sorted(r["hashes"], r["n"]) for r in rows])
    counts = np.concatenate([unpack(r["counts"], r["n"], np.uint32) for r in rows]).astype(np.int64)
    role = np.repeat([r["role"] for r in rows], sizes)
    order = np.argsort(hashes, kind="stable")
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = hashes[order][1:] != hashes[order][:-1]
    number = np.empty(len(hashes), np.int64)
    number[order] = np.cumsum(fresh) - 1
    n = int(fresh.sum())
    core = np.bincount(number, np.where(role == TRAIN, counts, 0), n).astype(np.int64)
    full = core + np.bincount(number, np.where(role == DELETED, counts, 0), n).astype(np.int64)
    out, at = [], 0
    kind = rows[0]["kind"]
    for r in rows:
        mine = number[at:at + r["n"]]
        own = counts[at:at + r["n"]] if r["role"] != HELD_OUT else 0
        out.append((r["chunk"], r["role"], kind, r["bucket"], r["n"], pack((full[mine] - own).astype(np.uint64)),
                    pack(core[mine].astype(np.uint64)) if r["role"] == DELETED else None))
        at += r["n"]
    totals = np.array([full.sum(), (full > 0).sum(), core.sum(), (core > 0).sum()], np.int64)
    out.append((None, None, kind, rows[0]["bucket"], 0, totals.tobytes(), None))
    return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), _ANSWER.types)], schema=_ANSWER)


_ANSWER = pa.schema([("chunk", pa.int64()), ("role", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int64()), ("n", pa.int32()),
                     ("full", pa.binary()), ("core", pa.binary())])


def _counts(chunk: Chunk, answers: pa.Table, field: str, own: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every token the counts of the pair, the context and the word."""
    lists: list[list[np.ndarray]] = [[], []]
    for r in sorted(answers.to_pylist(), key=lambda r: (r["kind"], r["bucket"])):
        lists[r["kind"]].append(unpack(r[field], r["n"], np.uint64).astype(np.int64))
    words = np.concatenate(lists[0])
    pairs = np.concatenate(lists[1])
    _, index, mine = np.unique(chunk.pair_of_token, return_inverse=True, return_counts=True)
    if own:  # the answer to a training chunk leaves out what it has itself
        words = words + np.bincount(chunk.numbers, minlength=len(words))
        pairs = pairs + mine
    return pairs[index], words[chunk.before], words[chunk.numbers]


def _estimates(pair: np.ndarray, context: np.ndarray, word: np.ndarray, tokens: int, distinct: int):
    """(context bucket, estimate by pair, by word, uniform)."""
    bucket = np.where(context > 0, np.minimum(1 + np.log2(np.maximum(context, 1)).astype(np.int64), CONTEXTS - 1), 0)
    return bucket, pair / np.maximum(context, 1), word / max(tokens, 1), 1.0 / (distinct + 1)


# --- The model ------------------------------------------------------------------------------


def learn_weights(cells: list[tuple[int, float, float, float]], uniform: float) -> np.ndarray:
    """(CONTEXTS, 3) mixture weights by expectation-maximisation.

    ``cells`` are (context bucket, tokens, mean estimate by pair, mean estimate by word) of the
    deleted documents. One token's worth is spread over the three estimates beforehand, so no
    weight is 0; a bucket without tokens takes the weights of all buckets together.
    """
    table = np.array(cells, float).reshape(-1, 4)

    def fit(rows: np.ndarray) -> np.ndarray:
        p = np.stack([rows[:, 2], rows[:, 3], np.full(len(rows), uniform)], 1)
        w = np.full(3, 1 / 3)
        for _ in range(EM_ROUNDS):
            part = p * w
            part *= (rows[:, 1] / np.maximum(part.sum(1), 1e-300))[:, None]
            w = (part.sum(0) + 1 / 3) / (rows[:, 1].sum() + 1)
        return w

    whole = fit(table)
    return np.stack([fit(rows) if len(rows := table[table[:, 0] == b]) else whole for b in range(CONTEXTS)])


def _cells(tokens: int, distinct: int):
    """Group function on a deleted chunk and its answers: the tokens by context bucket and by
    the sizes of the estimates, with the sums of the estimates."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for row in left.to_pylist():
            bucket, by_pair, by_word, uniform = _estimates(*_counts(Chunk(row), right, "core", False), tokens, distinct)
            level = lambda p: np.where(p > 0, 1000 + np.round(CELL * np.log2(np.maximum(p, 1e-300) / uniform)), 0).astype(np.int64)
            key, where = np.unique((bucket << 24) | (level(by_pair) << 12) | level(by_word), return_inverse=True)
            parts.append((key, np.bincount(where), np.bincount(where, by_pair), np.bincount(where, by_word)))
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0)] * 4
        return pa.table({"cell": columns[0].astype(np.int64), "n": columns[1].astype(np.int64), "pair": columns[2].astype(float), "word": columns[3].astype(float)})

    return run


def _scores(weights: np.ndarray, tokens: int, distinct: int, schema: pa.Schema):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for i, row in enumerate(left.select(["role", "sizes", "n_words", "words", "numbers"]).to_pylist()):
            chunk = Chunk(row)
            pair, context, word = _counts(chunk, right, "full", row["role"] != HELD_OUT)
            bucket, by_pair, by_word, uniform = _estimates(pair, context, word, tokens, distinct)
            w = weights[bucket]
            p = np.log10(w[:, 0] * by_pair + w[:, 1] * by_word + w[:, 2] * uniform)
            base = np.log10((word + 0.1) / (tokens + 0.1 * (distinct + 1)))
            first = np.cumsum(chunk.sizes) - chunk.sizes
            ids = left["ids"].combine_chunks()[i].values
            out.append(pa.Table.from_arrays(
                [ids, pa.array(chunk.sizes), pa.array(np.add.reduceat((word > 0).astype(np.int64), first)),
                 pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(p, first))], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def score(df: DataFrame, role: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows of ``df`` whose ``role`` is DELETED or TRAIN and score all rows.

    Returns for every row ``id_col``, n_tokens, n_known (tokens seen in training), train_tokens,
    base_score (unigrams with 0.1 added) and score, both log10 probabilities of the whole text
    with its end. A null text counts as empty: its end is its only token. Repeated rows and
    null ids come out as they are, an empty table gives an empty result, no other column is
    read. Words and pairs are told apart by 64-bit hashes.
    """
    spark = df.sparkSession
    bounded_arrow_batches(spark)
    narrow = df.select(F.col(f"`{id_col}`").alias("id"), role.cast("int").alias("role"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    limit = int(min(MOST_CHUNK_BYTES, CHUNK_BYTES * max(1.0, (total / PLAIN_BYTES) ** 0.5)))
    bits = max(1, (total // BUCKET_BYTES).bit_length())
    id_type = narrow.schema["id"].dataType
    kind = id_type.simpleString()
    chunks = stage(spark, narrow.mapInArrow(_chunks(limit), T.StructType.fromDDL(
        f"chunk long, role int, ids array<{kind}>, sizes array<int>, n_words int, words binary, numbers binary")), "lm-chunks")
    asked = chunks.mapInArrow(_asks(bits), "kind int, bucket long, chunk long, role int, n int, hashes binary, counts binary")
    answers = stage(spark, asked.groupBy("kind", "bucket").applyInArrow(
        _answers, "chunk long, role int, kind int, bucket long, n int, full binary, core binary"), "lm-answers")
    sums = np.zeros(4, np.int64)
    for r in answers.where("chunk is null and kind = 0").select("full").toLocalIterator():
        sums += np.frombuffer(bytes(r["full"]), np.int64)
    tokens, distinct, core_tokens, core_distinct = map(int, sums)
    told = answers.where("chunk is not null")

    def together(which: str, function, schema):
        return chunks.where(which).groupBy("chunk").cogroup(told.where(which).groupBy("chunk")).applyInArrow(function, schema)

    cells = together(f"role = {DELETED}", _cells(core_tokens, core_distinct), "cell long, n long, pair double, word double")
    found = cells.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("pair").alias("pair"), F.sum("word").alias("word")).orderBy("cell").collect()
    weights = learn_weights([(r.cell >> 24, r.n, r.pair / r.n, r.word / r.n) for r in found], 1.0 / (core_distinct + 1))
    out = T.StructType([T.StructField("id", id_type)]).add("n_tokens", "long").add("n_known", "long").add("base_score", "double").add("score", "double")
    arrow = pa.schema([("id", _arrow_type(id_type)), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    scored = together("true", _scores(weights, tokens, distinct, arrow), out)
    return scored.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def op6_lm_score(spark, sf_dir: str) -> DataFrame:
    residue = id_residue(F.col("doc_id"), 10)
    role = F.when(residue == 0, HELD_OUT).when(residue == 1, DELETED).otherwise(TRAIN)
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(residue == 0, F.lit(False))
    return score(docs, role).withColumn("held_out", held_out).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
