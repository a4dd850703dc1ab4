"""Mixing sources to target weights by fixed-length blocks.

Each source's documents, in a hashed order, are one long run of words, cut into blocks of
BLOCK_WORDS. Every output shard draws how many blocks it takes from each source; the draws of
a source over the shards are multinomial and add up to what its target asks for. A source's
draws are numbered through all shards; number t takes the block that a pseudorandom
permutation of the source's block numbers puts at place t, anew for each pass over the source,
with a shorter last block at the end of each pass. So every block is taken once before any is
taken twice. Of the last block drawn only as many words are taken as the target still lacks, so
each source comes within a word of its target, however small it is. Blocks and draws meet by index.

Sources are rows throughout, so there may be as many as documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.operators.numbering import number_rows

from . import kernels as K
from .common import WORD, documents, partitions_for, stage, word_count

# Words of a block, and about as many of an output shard.
BLOCK_WORDS = 64
SHARD_WORDS = 1 << 22

# Sources that are broadcast to their rows, and joined by shuffle beyond.
BROADCAST_SOURCES = 1 << 16

# Documents that one task puts in order when the sources' words are numbered.
BUCKET_ROWS = 4_000

# Draws that one task turns into blocks.
TASK_DRAWS = 1 << 18

# Shards of a source in one batch.
PIECES = 1 << 16

# Fixed values of the contract: the weights by rank of the source, the mix's size, the stop.
WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
MOST = 2

SEED = 20240817


def share_unit(sources: DataFrame, total: Fraction, most: int = MOST) -> Fraction:
    """What a weight of 1 gets when ``total`` is shared by weight among ``sources`` (weight,
    source_size) and none gets above ``most`` times its size, what it leaves being reshared.

    A source is full when its weight asks for more than that. The unit only rises as sources
    fill up, so a full one stays full; each round sums over what is not full, until no more
    fill up. Zero if all are full."""
    unit, full = Fraction(0), -1
    while True:
        above = F.col("weight").cast("decimal(38,0)") * F.lit(str(unit.numerator)).cast("decimal(38,0)") > \
            F.col("source_size").cast("decimal(38,0)") * F.lit(str(most * unit.denominator)).cast("decimal(38,0)")
        found = sources.agg(F.count_if(above).alias("full"), F.sum(F.when(above, F.col("source_size"))).alias("held"),
                            F.sum(F.when(~above, F.col("weight"))).alias("weight")).first()
        if found.full == full or not found.weight:
            return unit if found.weight else Fraction(0)
        full = found.full
        unit = (total - most * (found.held or 0)) / found.weight


def draw_counts(n: int, shards: int, key: int) -> tuple[np.ndarray, np.ndarray]:
    """(shards, counts): where the ``n`` draws of one source fall, each on any shard alike; the same for the same ``key``."""
    rng = np.random.default_rng([SEED, key])
    if n < shards:
        return np.unique(rng.integers(0, shards, n), return_counts=True)
    counts = rng.multinomial(n, np.full(shards, 1 / shards))
    return np.flatnonzero(counts), counts[counts > 0]


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..size-1 at ``index``: a four-round Feistel network on
    the least even number of bits that hold ``size``, walked until it falls below ``size``."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = K.U((1 << half) - 1)
    rounds = K.mix(np.arange(1, 5, dtype=np.uint64) * K.U(0x9E3779B97F4A7C15) ^ K.U(key & (1 << 64) - 1))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> K.U(half), x & mask
        for r in rounds:
            left, right = right, left ^ (K.mix(right ^ r) & mask)
        return left << K.U(half) | right

    x = once(index.astype(np.uint64))
    while (out := x >= size).any():
        x[out] = once(x[out])
    return x.astype(np.int64)


@dataclass
class Mix:
    """What a mix is made of.

    rows: row, number (of the source), size and all columns that were kept.
    sources: number, source, source_size, target, want (words to take), blocks (of a full length), tail (words of a shorter last one).
    fragments: number, block, at (where it begins in the block), row, word (where in its document), words.
    slots: shard, slot, number, block, taken (words of the block that are taken, from its beginning).
    """

    rows: DataFrame
    sources: DataFrame
    fragments: DataFrame
    slots: DataFrame

    def taken(self) -> DataFrame:
        """(row, words): words taken of each document, repeats counted; only what is taken."""
        return self.spans().groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("words"))

    def spans(self) -> DataFrame:
        """(row, word, words, times): how often each stretch of a document is taken. A block is cut short once at most."""
        whole = F.col("taken") == BLOCK_WORDS
        times = self.slots.groupBy("number", "block").agg(
            F.count_if(whole).alias("times"), F.max(F.when(~whole, F.col("taken"))).alias("short"))
        # The slots come from a short table of draws; without the hint Spark takes them for short.
        met = self.fragments.join(times.hint("merge"), ["number", "block"])
        part = F.when(F.col("short").isNotNull(), F.least(F.col("words"), F.col("short") - F.col("at"))).otherwise(0)
        takes = F.array(F.struct("words", "times"), F.struct(part.alias("words"), F.lit(1).cast("long").alias("times")))
        return met.select("row", "word", F.explode(F.filter(takes, lambda t: (t["words"] > 0) & (t["times"] > 0))).alias("t")).select(
            "row", "word", "t.words", "t.times")

    def blocks(self) -> DataFrame:
        """(shard, slot, row, word, words): the mix itself, block after block."""
        met = self.slots.hint("merge").join(self.fragments, ["number", "block"])
        words = F.least(F.col("words"), F.col("taken") - F.col("at"))
        return met.select("shard", "slot", "row", "word", words.alias("words")).where("words > 0")


def _sources(read: DataFrame, total: int) -> DataFrame:
    """The sources of ``read`` (of, words_in) by rank, with their targets."""
    found = read.groupBy("of").agg(F.sum("words_in").alias("source_size")).withColumn("none", F.col("of").isNull())
    ranked = number_rows(found, ["none", "of"], 0, "number")
    weight = F.element_at(F.array(*(F.lit(w) for w in WEIGHTS)), (F.col("number") % len(WEIGHTS)).cast("int") + 1)
    ranked = ranked.select("number", F.col("of").alias("source"), "source_size", weight.cast("long").alias("weight"))
    unit = share_unit(ranked, SHARE * total)
    # Sources that are not full share by weight, so there is one target a weight.
    open_target = F.create_map(*(x for w in set(WEIGHTS) for x in (F.lit(w).cast("long"), F.struct(
        F.lit(float(w * unit)).alias("target"), F.lit(round(w * unit)).cast("long").alias("want")))))[F.col("weight")]
    most = F.col("source_size") * MOST
    full = (open_target["target"] >= most) | F.lit(unit == 0)
    return ranked.select(
        "number", "source", "source_size", F.when(full, most.cast("double")).otherwise(open_target["target"]).alias("target"),
        F.when(full, most).otherwise(F.least(most, open_target["want"])).alias("want"),
        F.expr(f"source_size div {BLOCK_WORDS}").alias("blocks"), (F.col("source_size") % BLOCK_WORDS).alias("tail"))


def plan_mix(df: DataFrame, keep: list[str], text_col: str = "text", source_col: str = "source", id_col: str = "doc_id") -> Mix:
    """Plan a mix of all rows of ``df``, keeping the columns ``keep`` with the rows.

    Sources are ranked by code point, null last (null is a source of its own) and weighted
    WEIGHTS in turn. A null or empty text has no words and is never taken; a source without
    words has target 0. Repeated rows count each. The same table gives the same mix.
    """
    spark = df.sparkSession
    text = F.col(f"`{text_col}`")
    order = F.xxhash64(F.col(f"`{id_col}`").cast("string"), text, F.lit(SEED))
    read = stage(spark, df.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").cast("string").alias("of"), word_count(text).alias("words_in"), order.alias("h"),
        *([F.struct(*(F.col(f"`{c}`") for c in keep)).alias("kept")] if keep else [])), "mix-rows")
    sums = read.agg(F.coalesce(F.sum("words_in"), F.lit(0)).alias("words"), F.count("*").alias("rows")).first()
    sources = stage(spark, _sources(read, sums.words), "mix-sources")
    few = sources.count() <= BROADCAST_SOURCES
    named = sources.select(F.col("number").cast("int").alias("number"), "source")
    rows = read.join(F.broadcast(named) if few else named.hint("merge"), F.col("of").eqNullSafe(F.col("source"))).select(
        "row", "id", "number", F.col("words_in").alias("size"), "h", *(["kept"] if keep else []))

    # Where each document begins in its source: bucket by bucket, in hashed order within one.
    # A source holding most rows has as many buckets as it needs, so no task sorts it whole.
    buckets = max(1, -(-sums.rows // BUCKET_ROWS))
    placed = rows.where("size > 0").select("row", "id", "number", "size", "h", F.pmod("h", F.lit(buckets)).alias("bucket"))
    totals = placed.groupBy("number", "bucket").agg(F.sum("size").alias("n"))
    before = totals.select("number", "bucket", (F.sum("n").over(
        Window.partitionBy("number").orderBy("bucket")) - F.col("n")).alias("before"))
    within = Window.partitionBy("number", "bucket").orderBy("h", "id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    begin = placed.withColumn("own", F.coalesce(F.sum("size").over(within), F.lit(0))).join(before, ["number", "bucket"]).select(
        "row", "number", "size", (F.col("own") + F.col("before")).alias("begin"))
    cut = begin.withColumn("block", F.explode(F.expr(
        f"sequence(begin div {BLOCK_WORDS}, (begin + size - 1) div {BLOCK_WORDS})")))
    low = F.greatest(F.col("begin"), F.col("block") * BLOCK_WORDS)
    high = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * BLOCK_WORDS)
    fragments = cut.select("number", "block", (low - F.col("block") * BLOCK_WORDS).alias("at"), "row",
                           (low - F.col("begin")).alias("word"), (high - low).alias("words"))

    shards = max(1, -(-int(SHARE * sums.words) // SHARD_WORDS))
    asked = sources.where("want > 0").select(F.col("number").cast("int").alias("number"), "source", "source_size", "want", "blocks", "tail")
    tasks = partitions_for(spark, int(SHARE * sums.words) // BLOCK_WORDS, TASK_DRAWS)
    draws = asked.mapInArrow(_draws(shards), "shard int, number int, n long, first long, want long, source_size long, blocks long, tail long, key long")
    slots = draws.repartition(tasks, "shard", "number", "first").mapInArrow(_slots, "shard int, slot long, number int, block long, taken long")
    return Mix(rows.drop("h"), sources, fragments, slots)


def _draws(shards: int):
    """Rows of sources to rows of (shard, source): how many blocks the shard draws, and the number of the first of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                key = int.from_bytes(sha256(repr(s["source"]).encode()).digest()[:7], "big")
                passes, rest = divmod(s["want"], s["source_size"])
                n = passes * (s["blocks"] + (s["tail"] > 0)) + -(-rest // BLOCK_WORDS)
                shard, counts = draw_counts(n, shards, key)
                first = np.cumsum(counts) - counts
                same = {c: s[c] for c in ("want", "source_size", "blocks", "tail")}
                for a in range(0, len(shard), PIECES):
                    # A draw that is too long for one task goes in pieces.
                    parts = -(-counts[a:a + PIECES] // TASK_DRAWS)
                    of = np.repeat(np.arange(a, a + len(parts)), parts)
                    skip = (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)) * TASK_DRAWS
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard[of].astype(np.int32)), pa.array(np.full(len(of), s["number"], np.int32)),
                         pa.array(np.minimum(TASK_DRAWS, counts[of] - skip)), pa.array(first[of] + skip),
                         *(pa.array(np.full(len(of), x, np.int64)) for x in (*same.values(), key))],
                        names=["shard", "number", "n", "first", *same, "key"])
    return run


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every draw as the block it takes and the words taken of it. Its place in the shard is hashed."""
    for batch in batches:
        for o in batch.to_pylist():
            t = np.arange(o["first"], o["first"] + o["n"])
            blocks, in_pass = o["blocks"], o["blocks"] + (o["tail"] > 0)
            turn, place = t // in_pass, t % in_pass
            block = place.copy()  # the short last block comes last
            for k in np.unique(turn):
                mine = (turn == k) & (place < blocks)
                if mine.any():
                    block[mine] = permuted(place[mine], blocks, o["key"] + int(k) * 0x632BE59BD9B4E019)
            # What the source's target lacks when this draw comes; a whole block counts as one even if it is the short one.
            lacks = o["want"] - turn * o["source_size"] - place * BLOCK_WORDS
            taken = np.where((lacks >= BLOCK_WORDS) | (place == blocks) & (lacks >= o["tail"]), BLOCK_WORDS, lacks)
            slot = K.mix(K.mix(t.astype(np.uint64)) ^ K.U((o["key"] + SEED) & (1 << 64) - 1)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(t), o["shard"], np.int32)), pa.array(slot), pa.array(np.full(len(t), o["number"], np.int32)),
                 pa.array(block), pa.array(taken)], names=["shard", "slot", "number", "block", "taken"])


def mixed_documents(df: DataFrame, text_col: str = "text", n_chars_col: str | None = "n_chars") -> DataFrame:
    """What the mix takes of each document, as documents with the columns of ``df``.

    The text is the taken stretches in order, words parted by one space, a stretch taken twice
    standing twice; ``n_chars_col`` follows it. Documents of which nothing is taken go.
    """
    mix = plan_mix(df, df.columns)
    spans = mix.spans().groupBy("row").agg(F.array_sort(F.collect_list(F.struct("word", "words", "times"))).alias("spans"))
    words = F.regexp_extract_all(F.col("kept").getField(text_col), F.lit(f"({WORD})"), 1)
    # As the one element of an array the words are a variable, made once and not for each span.
    cut = mix.rows.join(spans.hint("merge"), "row").withColumn("held", F.array(words))
    text = F.expr("""array_join(transform(held, w -> flatten(transform(spans, s -> flatten(
        array_repeat(slice(w, cast(s.word as int) + 1, cast(s.words as int)), cast(s.times as int))))))[0], ' ')""")
    made = cut.withColumn("mixed", text)
    kinds = dict(df.dtypes)

    def column(c: str):
        if c == text_col:
            return F.col("mixed")
        if c == n_chars_col:
            return F.char_length("mixed").cast(kinds[c])
        return F.col("kept").getField(c)

    return made.select(*(column(c).alias(c) for c in df.columns))


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    mix = plan_mix(documents(spark, sf_dir), [])
    sources = mix.sources.select("number", "source_size", "target")
    rows = mix.rows.join(F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources.hint("merge"), "number")
    return rows.join(mix.taken().hint("merge"), "row", "left").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        F.coalesce("words", F.lit(0)).cast("long").alias("taken"))
