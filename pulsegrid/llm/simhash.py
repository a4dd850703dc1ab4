"""Document fingerprints by SimHash, and the search for near ones, from DataFrame functions only.

Terms are the word 5-shingles of a text. Each term's 64-bit hash votes for or against every
bit with the weight of the term, which is how often it occurs; the sign of a bit's votes is
the fingerprint's bit. Near fingerprints are found in block tables, one for each block of bits
as its key: of two fingerprints within the radius some block differs in few bits, so a query
that asks each table for its own key and all keys a few bits off meets any near one.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, documents, stage

BITS = 64
SHINGLE = 5

# Hamming distance within which op1 counts fingerprints as near: what texts with a shingle
# Jaccard similarity of 0.75 have on average. Sets of one size with Jaccard J have the cosine
# 2J / (1 + J), and a bit differs with probability arccos(cosine) / pi: 64 x 0.172 = 11.
RADIUS = 11

# Most tables of the search, and what a key asked for costs beside a fingerprint compared.
MOST_TABLES = 4
PROBE_COST = 20

# Text that one bucket of neighbouring documents holds; cells are the finer steps from which
# buckets are put together.
BUCKET_BYTES = 4 << 20
CELLS_PER_BUCKET = 8

# The table of cells is broadcast up to this many rows, and joined by shuffle beyond.
BROADCAST_CELLS = 1 << 20


def terms(text: Column) -> Column:
    """Hashes of the text's word shingles, one for each occurrence; a text of fewer words has
    its whole sequence as the one term, an empty or null text none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(held: Column) -> Column:
        count = F.size(held)
        starts = F.when(count > 0, F.sequence(F.lit(1), F.greatest(count - (SHINGLE - 1), F.lit(1)))).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(held, i, SHINGLE)))

    # As the one element of an array the hashes are a variable, made once and not for each window.
    return F.transform(F.array(hashes), windows)[0]


def fingerprints(df: DataFrame, keys: list[str], texts: dict[str, Column]) -> DataFrame:
    """``keys`` (which name a row) and, for each name in ``texts``, its text's fingerprint as a
    64-bit long. Votes are summed map-side, so only one short row a text is ever shuffled, and
    none at all where ``df`` already lies by one of the keys. No terms give fingerprint 0."""
    lists = df.select(*keys, *(terms(c).alias(f"_t{i}") for i, c in enumerate(texts.values())))
    bounds, whole = [F.lit(0)], []
    for i in range(len(texts)):
        bounds.append(bounds[-1] + F.size(f"_t{i}"))
        whole.append(F.col(f"_t{i}"))
    cut = lists.select(*keys, *(b.alias(f"_b{i}") for i, b in enumerate(bounds[1:])), F.concat(*whole).alias("_all"))
    votes = cut.select(*keys, *(f"_b{i}" for i in range(len(texts))), F.posexplode_outer("_all").alias("_pos", "_h"))
    which = sum(((F.col("_pos") >= F.col(f"_b{i}")).cast("int") for i in range(len(texts) - 1)), F.lit(0))
    both = F.lit((1 << 32) + 1).cast("long")  # bits i and i + 32 are counted in the two halves of one long
    # A term may stand 2**31 times in a text before a half overflows.
    counted = votes.groupBy(*keys, F.coalesce(which, F.lit(0)).alias("_which")).agg(
        F.count("_h").alias("_n"),
        *(F.sum(F.shiftrightunsigned("_h", i).bitwiseAND(both)).alias(f"_v{i}") for i in range(32)))
    low = F.lit((1 << 32) - 1).cast("long")
    bits = F.lit(0).cast("long")
    for i in range(32):
        v = F.coalesce(F.col(f"_v{i}"), F.lit(0))
        for votes_for, at in ((v.bitwiseAND(low), i), (F.shiftrightunsigned(v, 32), i + 32)):
            one = (1 << at) - (1 << 64 if at == 63 else 0)
            bits = bits.bitwiseOR(F.when(votes_for * 2 > F.col("_n"), F.lit(one).cast("long")).otherwise(F.lit(0).cast("long")))
    signed = counted.select(*keys, "_which", bits.alias("_bits"))
    zero = F.lit(0).cast("long")
    return signed.groupBy(*keys).agg(
        *(F.coalesce(F.max(F.when(F.col("_which") == i, F.col("_bits"))), zero).alias(name) for i, name in enumerate(texts)))


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), BITS // 4, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


# --- Search ---------------------------------------------------------------------------------


def block_tables(rows: int, radius: int) -> list[tuple[int, int, int]]:
    """(first bit, end bit, bits off) of each table's block: fingerprints at most ``radius`` bits
    apart are no more than that many bits apart in one of the blocks. Fewer blocks make longer
    keys, which fewer of ``rows`` fingerprints share, and more keys to ask for."""

    def cut(blocks: int) -> list[tuple[int, int, int]]:
        each, over = divmod(radius, blocks)
        edge = [BITS * i // blocks for i in range(blocks + 1)]
        off = [each if i <= over else each - 1 for i in range(blocks)]
        return [(a, b, k) for a, b, k in zip(edge[:-1], edge[1:], off, strict=True) if k >= 0]

    def cost(tables: list[tuple[int, int, int]]) -> float:
        return sum(sum(comb(b - a, i) for i in range(k + 1)) * (PROBE_COST + rows / 2 ** (b - a)) for a, b, k in tables)

    return min(map(cut, range(MOST_TABLES, 1, -1)), key=cost)


def near_fingerprints(index: DataFrame, queries: DataFrame, rows: int, radius: int = 3) -> DataFrame:
    """All pairs (query, found) of fingerprints at most ``radius`` bits apart, equal ones too.

    Both sides have one column ``fingerprint`` of distinct values. Each pair comes out once,
    from the first table in which the two meet.
    """
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    tables = block_tables(rows, radius)
    masks = [F.lit(signed((1 << b) - (1 << a))).cast("long") for a, b, _ in tables]
    flips = [(t, signed(sum(1 << x for x in chosen))) for t, (a, b, k) in enumerate(tables)
             for n in range(k + 1) for chosen in combinations(range(a, b), n)]
    probes = index.sparkSession.createDataFrame(flips, "table int, flip long")  # no rows of data: a list by radius
    mask = F.element_at(F.array(*masks), F.col("table") + 1)
    left = queries.join(F.broadcast(probes)).select(
        F.col("fingerprint").alias("query"), "table", F.col("fingerprint").bitwiseAND(mask).bitwiseXOR(F.col("flip")).alias("key"))
    keys = F.array(*(F.col("fingerprint").bitwiseAND(m) for m in masks))
    right = index.select(F.col("fingerprint").alias("found"), F.posexplode(keys).alias("table", "key"))
    apart = F.col("query").bitwiseXOR(F.col("found"))
    first = F.coalesce(*(F.when(F.bit_count(apart.bitwiseAND(m)) <= k, F.lit(i))
                         for i, (m, (_, _, k)) in enumerate(zip(masks, tables, strict=True))))
    return left.alias("q").join(
        right.alias("x"),
        (F.col("q.table") == F.col("x.table")) & (F.col("q.key") == F.col("x.key"))
        & (F.bit_count(apart) <= radius) & (first == F.col("q.table")),
    ).select("query", "found")


def near_counts(prints: DataFrame, is_query: Column, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, n_near) of the query rows' fingerprints: rows of ``prints`` (column
    ``fingerprint``) within the radius, the row itself left out."""
    held = stage(prints.sparkSession, prints.groupBy("fingerprint").agg(
        F.count("*").alias("rows"), F.max(is_query).alias("asked")), "simhash-distinct")
    pairs = near_fingerprints(held.select("fingerprint"), held.where("asked").select("fingerprint"), held.count(), radius)
    return pairs.join(held.select(F.col("fingerprint").alias("found"), "rows"), "found").groupBy(
        F.col("query").alias("fingerprint")).agg((F.sum("rows") - 1).alias("n_near"))


# --- Neighbours by id -----------------------------------------------------------------------


def with_next(df: DataFrame) -> DataFrame:
    """Rows (id, text) with the text of the next row in descending id, the first after the last.

    Returns bucket, place, guest, id, text, next_text. Rows lie by ``bucket``, a stretch of
    ids, in order of ``place``. A bucket's last rows may be guests: copies of the next bucket's
    first row, there so that neighbours share a task. Null ids come last; rows with equal ids
    are ordered by a hash of their text. The texts are shuffled once.
    """
    spark = df.sparkSession
    tie = F.xxhash64("text")
    ends = df.agg(F.min("id").alias("a"), F.max("id").alias("b"), F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("n")).first()
    cells = max(1, CELLS_PER_BUCKET * (-(-(ends.n or 0) // BUCKET_BYTES)))
    low, high = float(ends.a or 0), float(ends.b or 0) + 1.0
    cell = F.coalesce(F.expr(f"width_bucket(cast(id as double), {low!r}D, {high!r}D, {cells})"), F.lit(0))
    weights = stage(spark, df.groupBy(cell.alias("cell")).agg(
        F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("n"),
        F.max(F.struct(F.col("id").isNotNull().alias("known"), "id", tie.alias("tie"))).alias("first")), "simhash-cells")
    # A few rows for every bucket from here on: cells -> buckets, and each bucket's first row.
    upto = Window.orderBy("cell")
    numbered = weights.withColumn("step", F.floor((F.sum("n").over(upto) - F.col("n")) / BUCKET_BYTES)).withColumn(
        "bucket", F.dense_rank().over(Window.orderBy("step")) - 1)
    tops = numbered.groupBy("bucket").agg(F.max("first").alias("top"))
    count = F.count("*").over(Window.partitionBy())
    hosts = tops.select("bucket", "top", F.pmod(F.col("bucket") + 1, count).alias("host"))
    table = stage(spark, numbered.select("cell", "bucket").join(hosts, "bucket"), "simhash-buckets")
    if table.count() <= BROADCAST_CELLS:
        table = F.broadcast(table)
    placed = df.withColumn("cell", cell).join(table, "cell")
    is_top = F.col("id").eqNullSafe(F.col("top.id")) & (tie == F.col("top.tie"))
    stay = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    visit = F.struct(F.col("host").alias("bucket"), F.lit(True).alias("guest"))
    spread = placed.select("id", "text", F.explode(F.when(is_top, F.array(stay, visit)).otherwise(F.array(stay))).alias("at"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("id").desc_nulls_last(), tie.desc())
    return spread.select("at.bucket", "at.guest", "id", "text").select(
        "bucket", F.row_number().over(order).alias("place"), "guest", "id", "text", F.lead("text").over(order).alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """The last floor(n/2) code points of ``text`` replaced by the first as many of ``following``."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    """The contract's columns, and n_near: for rows whose id is divisible by 50, how many other
    documents have a fingerprint within RADIUS bits; null for the rest."""
    docs = documents(spark, sf_dir).select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    near = with_next(docs).withColumn("edited", edited(F.col("text"), F.coalesce("next_text", F.lit(""))))
    named = near.select(
        "bucket", "place", "guest", "id", F.char_length("text").cast("long").alias("n_chars"),
        F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("sha"), "text", "edited")
    keys = ["bucket", "place", "guest", "id", "n_chars", "sha"]
    prints = fingerprints(named, keys, {"fingerprint": F.col("text"), "edited_print": F.col("edited")})
    following = F.lead("fingerprint").over(Window.partitionBy("bucket").orderBy("place"))
    whole = stage(spark, prints.withColumn("next_print", following).where("not guest").select(
        "id", "n_chars", "sha", "fingerprint", "edited_print", "next_print"), "simhash-prints")
    asked = F.coalesce(F.col("id") % 50 == 0, F.lit(False))
    found = near_counts(whole, asked)
    return whole.join(found, "fingerprint", "left").select(
        F.col("id").alias("doc_id"), "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"),
        as_hex(F.col("fingerprint")).alias("fingerprint"), as_hex(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.coalesce("next_print", "fingerprint")).alias("near_next"),
        F.when(asked, F.col("n_near")).alias("n_near"))
