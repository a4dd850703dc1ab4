"""Suffix-array dedup by a depth-limited radix sort.

A suffix is ordered only through its first WIDTH bytes, digit by digit from the front; suffixes
that stay equal through all digits are exactly the repeated windows.

The leading digit is chosen so that most suffixes need no more: among the GRAM-byte strings of a
window the one with the least hash is its anchor. Equal windows have equal anchors at equal
offsets, and neighbouring windows share theirs, so one row for each anchor stands for all its
windows. Rows whose anchor occurs once drop out after this first pass, and only those left are
shuffled with their bytes. Each task then sorts the windows of its anchors by the offset
of the anchor and by eight-byte digits, dropping what stands alone after each pass.

An anchor that is met very often would gather too much in one task. Its windows are parted by
all their bytes at once, as a 128-bit hash, after copies within a task have met there.

Texts that several rows hold are repeated as a whole. One row of each goes through the passes, to
be found by others; all of them lose all their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .common import BATCH_BYTES, bounded_arrow_batches, byte_slices, documents, stage

# Bytes of a window, of an anchor, and of a digit.
WIDTH = 200
GRAM = 40
DIGIT = 8

# Occurrences from which an anchor is parted by whole windows.
OFTEN = 8_000

# Windows that a task decides on at once, and at most what one key has more (under OFTEN rows).
SORT_WINDOWS = 1 << 19

# Texts held by several rows that are broadcast, and joined by shuffle beyond.
BROADCAST_ROWS = 1 << 20

# Anchors above this share of all are "hot": at most HOT_KEYS of them, which meet their count in
# HOT_PARTS places.
HOT_KEYS = 10_000
HOT_PARTS = 64

# Position of an anchor in its run of rows: runs are shorter than this.
RUN_BITS = 22


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (width - span)], x[width - span:]) if span < width else x


def anchors(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, row, lo, hi, at) of a run of rows: the windows that start at lo..hi have their
    anchor, of hash ``key``, at ``at``. Positions count from the run's start."""
    none = np.empty(0, np.int64)
    if len(raw) < WIDTH:
        return none.view(np.uint64), none, none, none, none
    hashes = K.window_hashes(K.prefix_sums(raw), GRAM)
    place = K.U((1 << RUN_BITS) - 1)
    least = _sliding_min(hashes & ~place | np.arange(len(hashes), dtype=np.uint64), WIDTH - GRAM + 1)
    until = np.repeat(offsets[1:], np.diff(offsets))[:len(least)]
    start = np.flatnonzero(np.arange(len(least)) + WIDTH <= until)  # windows that end in their row
    at = (least[start] & place).astype(np.int64)
    fresh = np.ones(len(start), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(start))[:len(first)] - 1
    lo = start[first]
    return hashes[at[first]], np.searchsorted(offsets, lo, side="right") - 1, lo, start[last], at[first]


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, byte at which the piece begins in that row, bytes, offsets). A very long
    row comes in pieces that overlap by a window less one byte."""
    for a, _, raw, offsets in byte_slices(texts):
        if len(raw) <= 2 * BATCH_BYTES:
            yield a, 0, raw, offsets
            continue
        for begin in range(0, max(1, len(raw) - WIDTH + 1), BATCH_BYTES):
            piece = raw[begin:begin + BATCH_BYTES + WIDTH - 1]
            yield a, begin, piece, np.array([0, len(piece)])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, raw, offsets in _pieces(batch.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(anchors(raw, offsets)[0].view(np.int64))], names=["key"])


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, begin, raw, offsets in _pieces(batch.column(2)):
            key, row, lo, hi, at = anchors(raw, offsets)
            base = offsets[row] - begin
            take = pa.array(row + a)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), batch.column(0).take(take), batch.column(1).take(take),
                 *(pa.array((x - base).astype(np.int32)) for x in (lo, hi, at))],
                names=["key", "id", "h", "lo", "hi", "at"])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of all windows of each anchor, cut out of the row's text."""
    for batch in batches:
        ids, hs, texts, lists = (batch.column(i) for i in range(4))
        data = texts.cast(pa.binary())
        names = [f.name for f in lists.type.value_type]
        flat, ends = lists.flatten(), np.asarray(lists.offsets) - lists.offsets[0].as_py()
        of = np.repeat(np.arange(len(batch)), np.diff(ends))
        lo, hi = (np.asarray(flat.field(names.index(c)), np.int64) for c in ("lo", "hi"))
        order = np.lexsort([lo, of])  # in each row from front to back
        lo, hi, flat = lo[order], hi[order], flat.take(pa.array(order))
        for a in range(0, len(of), 4096):
            part = slice(a, a + 4096)
            cut = [data[r].as_buffer() for r in range(of[a], of[min(a + 4096, len(of)) - 1] + 1)]
            views = [memoryview(b) for b in cut]
            pieces = [bytes(views[r - of[a]][x:y + WIDTH]) for r, x, y in zip(of[part].tolist(), lo[part].tolist(), hi[part].tolist(), strict=True)]
            take = pa.array(of[part])
            yield pa.RecordBatch.from_arrays(
                [flat.field(names.index("key")).slice(a, 4096), ids.take(take), hs.take(take), flat.field(names.index("lo")).slice(a, 4096),
                 flat.field(names.index("at")).slice(a, 4096), pa.array(pieces, pa.binary()), flat.field(names.index("often")).slice(a, 4096)],
                names=["key", "id", "h", "lo", "at", "bytes", "often"])


PART_COLUMNS = ["key", "y", "more", "id", "h", "lo", "at", "bytes"]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What goes to the tasks that decide, dealt out by ``key``: of a rare anchor the anchor
    with its bytes; of a frequent one each window's hash (key, y) with its first and last byte,
    and the spans that are certain already, without y."""
    for batch in _segments(batches):
        often = batch.column(6)
        rare = batch.filter(pc.invert(often))
        none = pa.nulls(len(rare), pa.int64()), pa.nulls(len(rare), pa.bool_())
        yield pa.RecordBatch.from_arrays([rare.column(0), *none, *rare.columns[1:6]], names=PART_COLUMNS)
        for part in _part_often([batch.filter(often)]):
            x, y, more, ids, h, begin, end = part.columns
            yield pa.RecordBatch.from_arrays(
                [pc.coalesce(x, h), y, more, ids, h, begin, end, pa.nulls(len(part), pa.binary())], names=PART_COLUMNS)


def repeated_windows(raw: np.ndarray, starts: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Which windows of ``raw`` (at ``starts``) equal another one of their group: a radix sort
    from the front by DIGIT bytes, on groups first. A group whose digits are all alike is left
    as it is, any other is sorted by the digit and parted; what stands alone drops out."""
    padded = np.concatenate([raw, np.zeros(DIGIT, np.uint8)])
    digits = np.lib.stride_tricks.as_strided(padded[:DIGIT].view(">u8"), (len(raw) + 1,), (1,))

    def not_alone(fresh: np.ndarray) -> np.ndarray:
        return ~(fresh & np.append(fresh[1:], True))

    order = np.argsort(groups, kind="stable")
    group = groups[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = group[1:] != group[:-1]
    keep = not_alone(fresh)
    order, fresh = order[keep], fresh[keep]
    for depth in range(0, WIDTH, DIGIT):
        if not len(order):
            break
        digit = digits[starts[order] + min(depth, WIDTH - DIGIT)].astype(np.uint64)
        head = np.flatnonzero(fresh)
        sizes = np.diff(np.append(head, len(order)))
        unlike = np.logical_or.reduceat(digit != np.repeat(digit[head], sizes), head)
        if not unlike.any():
            continue
        mixed = np.repeat(unlike, sizes)
        number = np.repeat(np.arange(len(head)), sizes)[mixed]
        own, value = order[mixed], digit[mixed]
        by = np.lexsort([value, number])
        own, value, number = own[by], value[by], number[by]
        parted = np.ones(len(own), bool)
        parted[1:] = (value[1:] != value[:-1]) | (number[1:] != number[:-1])
        stays = not_alone(parted)
        order = np.concatenate([order[~mixed], own[stays]])
        fresh = np.concatenate([fresh[~mixed], parted[stays]])
    out = np.zeros(len(starts), bool)
    out[order] = True
    return out


def _windows(bytes_: pa.Array, lo: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(raw, starts, segment, first byte in the document, anchor offset) of all windows."""
    (_, _, raw, offsets), = byte_slices(bytes_, 1 << 62)
    count = np.diff(offsets) - WIDTH + 1
    segment = np.repeat(np.arange(len(count)), count)
    inside = np.arange(len(segment)) - np.repeat(np.cumsum(count) - count, count)
    return raw, offsets[segment] + inside, segment, lo[segment] + inside, at[segment] - lo[segment] - inside


def _spans(ids: pa.Array, hs: pa.Array, segment: np.ndarray, start: np.ndarray, row: np.ndarray | None = None) -> pa.RecordBatch:
    """Runs of repeated windows as spans of bytes of their documents. With ``row``, the number
    of each segment's document, a run goes on through segments that follow each other."""
    owner = segment if row is None else row[segment]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(start))[:len(first)] - 1
    take = pa.array(segment[first])
    return pa.RecordBatch.from_arrays(
        [ids.take(take), hs.take(take), pa.array(start[first].astype(np.int32)), pa.array((start[last] + WIDTH).astype(np.int32))],
        names=["id", "h", "begin", "end"])


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of :func:`_parts` arrive by key; whole keys are gathered up to SORT_WINDOWS windows.
    Those of rare anchors are sorted together; hashed ones are repeated when two rows have the
    same hash, or one stands for several; spans without hash are as they are."""
    def sort(table: pa.Table) -> pa.RecordBatch:
        key, lo, at = (np.asarray(table[c]) for c in ("key", "lo", "at"))
        number = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]).astype(np.int64)]))
        raw, starts, segment, first, offset = _windows(table["bytes"].combine_chunks(), lo.astype(np.int64), at.astype(np.int64))
        again = repeated_windows(raw, starts, number[segment] * WIDTH + offset)
        return _spans(table["id"].combine_chunks(), table["h"].combine_chunks(), segment[again], first[again])

    def same_hash(table: pa.Table) -> pa.Table:
        x, y, more = (np.asarray(table[c]) for c in ("key", "y", "more"))
        order = np.lexsort([y, x])
        x, y = x[order], y[order]
        fresh = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        group = np.cumsum(fresh) - 1
        repeated = (np.bincount(group) > 1) | (np.bincount(group, more[order].astype(bool)) > 0)
        return table.take(pa.array(order[repeated[group]]))

    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        has_bytes, hashed = table["bytes"].is_valid(), table["y"].is_valid()
        if pc.any(has_bytes).as_py():
            yield sort(table.filter(has_bytes))
        known = [table.filter(pc.invert(pc.or_(has_bytes, hashed)))]
        if pc.any(hashed).as_py():
            known.append(same_hash(table.filter(hashed)))
        for one in known:
            yield from one.select(["id", "h", "lo", "at"]).rename_columns(["id", "h", "begin", "end"]).combine_chunks().to_batches()

    def windows_in(table: pa.Table | pa.RecordBatch) -> int:
        segments = table.column(7)
        valid = len(segments) - segments.null_count
        return segments.null_count + ((pc.sum(pc.binary_length(segments)).as_py() or 0) - (WIDTH - 1) * valid if valid else 0)

    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        size += windows_in(batch)
        if size < SORT_WINDOWS:
            continue
        table = pa.concat_tables(held)
        key = np.asarray(table["key"])
        cut = int(np.argmax(key == key[-1]))  # the last key may go on in the next batch
        if cut:
            yield from solve(table.slice(0, cut))
        held = [table.slice(cut)]
        size = windows_in(held[0])
    if held:
        yield from solve(pa.concat_tables(held))


def _part_often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of frequent anchors by their whole content, hashed as (x, y).

    Of equal windows that meet in one run of rows the first is sent with its hash, ``more``
    set; the spans of the others are certain and come without hash.
    """
    names = ["x", "y", "more", "id", "h", "begin", "end"]
    for batch in batches:
        lo, at = (np.asarray(batch.column(i), np.int64) for i in (3, 4))
        for a, b, _, _ in byte_slices(batch.column(5)):
            part = batch.slice(a, b - a)
            raw, starts, segment, first, _ = _windows(part.column(5), lo[a:b], at[a:b])
            x = K.window_hashes(K.prefix_sums(raw), WIDTH)[starts]
            y = K.window_hashes(K.prefix_sums(255 - raw[::-1]), WIDTH)[len(raw) - WIDTH - starts]
            _, lead, back = np.unique(x ^ K.mix(y), return_index=True, return_inverse=True)
            many = np.bincount(back, minlength=len(lead)) > 1
            take = pa.array(segment[lead])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[lead].view(np.int64)), pa.array(y[lead].view(np.int64)), pa.array(many),
                 part.column(1).take(take), part.column(2).take(take), pa.array(first[lead].astype(np.int32)),
                 pa.array((first[lead] + WIDTH).astype(np.int32))], names=names)
            rest = np.ones(len(starts), bool)
            rest[lead] = False
            if rest.any():
                turn = [pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)), True) for c in part.columns[1:3]]
                row = np.concatenate([[0], np.cumsum(np.asarray(pc.or_(*turn)))])
                spans = _spans(part.column(1), part.column(2), segment[rest], first[rest], row)
                n = len(spans)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), *spans.columns], names=names)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n_bytes, spans, kept): maximal removed runs, and the bytes between them."""
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for i in range(len(batch)):
            found = sorted((s["begin"], s["end"]) for s in batch.column(2)[i].as_py() or ())
            runs: list[list[int]] = []
            for begin, end in found:
                if runs and begin <= runs[-1][1]:
                    runs[-1][1] = max(end, runs[-1][1])
                else:
                    runs.append([begin, end])
            data = texts[i].as_py()
            edges = [0, *(e for run in runs for e in run), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, 1), pa.array([len(data)], pa.int64()),
                 pa.array([[{"begin": a, "end": b} for a, b in runs]], pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
                 pa.array([kept], pa.binary())], names=["id", "n_bytes", "spans", "kept"])


def _batched(run, rows: int = 2048):
    """Gather the one-row batches of ``run`` into larger ones, up to ``rows`` or BATCH_BYTES."""
    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for one in run(batches):
            held.append(one)
            size += one.nbytes
            if len(held) >= rows or size >= BATCH_BYTES:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return gathered


def _same(a: DataFrame, b: DataFrame):
    return (a["h"] == b["h"]) & a["id"].eqNullSafe(b["id"])


def _named(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, text): a row is told by its id and a hash of its text. Rows equal in both are
    copies, which find each other and lose the same bytes."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def _copies(docs: DataFrame) -> DataFrame:
    """(digest, first) of the texts of WIDTH bytes or more that several rows hold, with the least id of them, null last."""
    rows = docs.where(F.octet_length("text") >= WIDTH).select(_digest().alias("digest"), _order().alias("at"))
    held = rows.groupBy("digest").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    return stage(docs.sparkSession, held.where("n > 1").drop("n"), "suffix-copies")


def _digest():
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _order():
    return F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"))


def _repeated_anchors(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of anchors that are met again, marked where that is ``often``."""
    counts = stage(rows.sparkSession, keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "suffix-keys")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") >= max(OFTEN, -(-total // HOT_KEYS))
    hot_keys = counts.where(hot).select("key", F.lit(True).alias("hot"))
    counts = counts.select("key", "n", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))).otherwise(F.array(F.lit(0)))).alias("part"))
    rows = rows.join(F.broadcast(hot_keys), "key", "left").withColumn(
        "part", F.when(F.col("hot"), F.pmod("h", F.lit(HOT_PARTS))).otherwise(0).cast("int"))
    return stage(rows.sparkSession, rows.join(counts.hint("merge"), ["key", "part"]).select(
        "key", "id", "h", "lo", "hi", "at", (F.col("n") >= OFTEN).alias("often")), "suffix-anchors")


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, begin, end): spans of bytes covered by windows that also start anywhere else;
    spans of one row may overlap."""
    spark = df.sparkSession
    bounded_arrow_batches(spark)
    docs = _named(df, id_col, text_col)
    kind = docs.schema["id"].dataType.simpleString()
    copies = _copies(docs)
    few = copies.count() <= BROADCAST_ROWS
    marked = docs.withColumn("digest", _digest()).join(F.broadcast(copies) if few else copies.hint("merge"), "digest", "left")
    whole = marked.where("first is not null").select("id", "h", F.lit(0).alias("begin"), F.octet_length("text").alias("end"))
    one = marked.where(F.col("first").isNull() | _order().eqNullSafe(F.col("first"))).select("id", "h", "text")

    keys = one.select("text").mapInArrow(_keys, "key long")
    rows = one.mapInArrow(_anchor_rows, f"key long, id {kind}, h long, lo int, hi int, at int")
    left = _repeated_anchors(rows, keys)
    # The texts that have such anchors are shuffled once, and give the bytes or hashes of them all.
    lists = left.groupBy("id", "h").agg(F.collect_set(F.struct("key", "lo", "hi", "at", "often")).alias("anchors"))
    texts = one.join(lists.hint("merge"), _same(one, lists)).select(one["id"], one["h"], "text", "anchors")
    parts = texts.mapInArrow(_parts, f"key long, y long, more boolean, id {kind}, h long, lo int, at int, bytes binary")
    found = parts.repartition("key").sortWithinPartitions("key").mapInArrow(_decide, f"id {kind}, h long, begin int, end int")
    return stage(spark, found.unionByName(whole), "suffix-spans")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row of ``df``: ``id_col``, n_bytes, spans (maximal removed runs of bytes) and
    kept (the bytes between them, in a row).

    A byte goes when a window of WIDTH bytes around it also starts anywhere else, in this row
    or another, judged on the input. A null text counts as empty; shorter texts keep all.
    Repeated rows are copies of each other. Null ids, empty tables and further columns, whatever
    their names, do no harm. Frequent anchors are compared by a 128-bit hash, others by bytes.
    """
    spark = df.sparkSession
    spans = repeated_spans(df, id_col, text_col)
    docs = _named(df, id_col, text_col)
    lists = spans.groupBy("id", "h").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    joined = docs.join(lists.hint("merge"), _same(docs, lists), "left").select(docs["id"], "text", "spans")
    kind = T.StructType([docs.schema["id"], *T.StructType.fromDDL(
        "n_bytes long, spans array<struct<begin:int,end:int>>, kept binary").fields])
    return joined.mapInArrow(_batched(_kept), kind).withColumnRenamed("id", id_col)


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    cut = remove_repeats(documents(spark, sf_dir))
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
