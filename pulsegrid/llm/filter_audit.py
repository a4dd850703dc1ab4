"""Filter interaction audit: what five document filters remove in every order they can run in.

Every document gets the mask of the filters it fails. Documents fall into cells by (part, mask),
32 a part at most, which are counted in Spark. One small row a part then holds all there is to
know: a Gray-code walk goes through the 32 sets of active filters, toggling one filter a step.
Each cell keeps the number of active filters it fails; when that count leaves or reaches zero,
the cell leaves or joins the running survivors. The survivors of the 32 sets are stored, and
every step of every order is a difference of two of them.

A text is the same as another by its SHA-256. Which row of a text comes first is a minimum
combined in every task, and rows find it by (text, id), so that copies do not meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, documents, stage

# Fixed values of the contract: the filters, their limits and what counts as a symbol.
FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
SYMBOL = "[#$%&*|]"

SETS = 1 << len(FILTERS)
MEASURES = ("docs", "good", "toxic")
STEP_COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDIT_SCHEMA = ("part string, filter_order string, step int, "
                + ", ".join(f"{c} long" for c in STEP_COLUMNS))


def text_failures(text: Column) -> Column:
    """The mask of filters A to D that a text fails: bit 0 is A. Null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, SPACE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    failed = [n < LEAST_WORDS, distinct * 100 < n * LEAST_DISTINCT_PERCENT,
              capitals * 100 > F.length(text) * MOST_CAPITALS_PERCENT, text.rlike(SYMBOL)]
    return sum((F.when(f, 1 << bit).otherwise(0) for bit, f in enumerate(failed)), F.lit(0))


def failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "lang") -> DataFrame:
    """(part, mask, good, toxic) of every row of ``docs``.

    E fails where a row of a smaller id has the same text; null ids come last, and rows that
    repeat an id fail or pass it together. A null text is empty, a null part the empty string.
    A document is good or toxic if any of its label rows says so; a null id has no label.
    """
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`")
    order = F.struct(F.col(f"`{id_col}`").isNull().alias("no_id"), F.col(f"`{id_col}`").alias("id"))
    rows = stage(spark, docs.select(
        order.alias("at"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)).alias("sha"),
        text_failures(text).alias("mask")), "audit-rows")
    first = rows.groupBy("sha").agg(F.min("at").alias("at")).withColumn("leads", F.lit(1 << FILTERS.index("E")))
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic")).where("id is not null")
    both = rows.join(first, ["sha", "at"], "left").join(marks, F.col("at.id") == F.col("id"), "left")
    copy = F.lit(1 << FILTERS.index("E")) - F.coalesce("leads", F.lit(0))
    return both.select("part", F.col("mask").bitwiseOR(copy).alias("mask"),
                       F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def cells(failed: DataFrame) -> DataFrame:
    """One row a part: the list of its cells (mask, docs, good, toxic), 32 at most."""
    counted = failed.groupBy("part", "mask").agg(
        F.count("*").alias("docs"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    return counted.groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))


def survivors(cell: list[tuple]) -> list[tuple]:
    """(docs, good, toxic) that pass each of the 32 sets of active filters, by the set's bits."""
    active_failures = [0] * len(cell)
    running = [sum(c[m] for c in cell) for m in range(1, len(MEASURES) + 1)]
    states: list = [None] * SETS
    states[0] = tuple(running)
    active = 0
    for step in range(1, SETS):
        toggled = step & -step  # the one bit in which the Gray codes of step - 1 and step differ
        active ^= toggled
        on = bool(active & toggled)
        for k, c in enumerate(cell):
            if not c[0] & toggled:
                continue
            before = active_failures[k]
            active_failures[k] += 1 if on else -1
            if before == 0 or active_failures[k] == 0:
                for m in range(len(MEASURES)):
                    running[m] += -c[m + 1] if on else c[m + 1]
        states[active] = tuple(running)
    return states


def audit_steps(states: list[tuple]) -> Iterator[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley) of every step of the 120 orders, as differences of the 32 states."""
    n = len(FILTERS)
    everything = SETS - 1
    fails, unique, shapley = {}, {}, {}
    for k, name in enumerate(FILTERS):
        bit = 1 << k
        fails[name] = states[0][0] - states[bit][0]
        unique[name] = states[everything ^ bit][0] - states[everything][0]
        # A filter runs right after exactly the set s in |s|! (n - 1 - |s|)! of the orders.
        shapley[name] = sum(
            factorial(s.bit_count()) * factorial(n - 1 - s.bit_count()) * (states[s][0] - states[s | bit][0])
            for s in range(SETS) if not s & bit)
    for order in permutations(FILTERS):
        done = 0
        for step, name in enumerate(order, 1):
            now = done | 1 << FILTERS.index(name)
            removed, good, toxic = (a - b for a, b in zip(states[done], states[now], strict=True))
            yield ("".join(order), step, states[now][0], removed, fails[name] - removed, unique[name], good, toxic,
                   shapley[name])
            done = now


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            steps = list(audit_steps(survivors([(c["mask"], *(c[m] for m in MEASURES)) for c in row["cells"]])))
            order, step, *rest = zip(*steps, strict=True)
            yield pa.record_batch(
                [pa.array([row["part"]] * len(steps), pa.string()), pa.array(order, pa.string()), pa.array(step, pa.int32()),
                 *(pa.array(c, pa.int64()) for c in rest)],
                names=["part", "filter_order", "step", *STEP_COLUMNS])


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "lang") -> DataFrame:
    """What every step of every order of the five filters keeps and removes, for each part.

    Returns 600 rows a part: part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley. Rows, nulls, ties and labels count as :func:`failures`
    says. An empty table has no parts, so no rows. Other columns, whatever their names, are
    not read."""
    return cells(failures(docs, labels, id_col, text_col, part_col)).mapInArrow(_audit, AUDIT_SCHEMA)


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit_filters(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id
), masks AS (
  SELECT part, coalesce(good, false)::int AS good, coalesce(toxic, false)::int AS toxic,
         (len(w) < 100)::int + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::int
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::int
         + 8 * regexp_matches(text, '[#$%&*|]')::int
         + 16 * (d.doc_id > min(d.doc_id) OVER (PARTITION BY text))::int AS mask
  FROM words d LEFT JOIN marks USING (doc_id)
), cells AS (
  SELECT part, mask, count(*) AS n, sum(good) AS g, sum(toxic) AS t FROM masks GROUP BY ALL
), sets AS (
  SELECT part, s, coalesce(sum(n) FILTER (mask & s = 0), 0) AS n, coalesce(sum(g) FILTER (mask & s = 0), 0) AS g,
         coalesce(sum(t) FILTER (mask & s = 0), 0) AS t
  FROM cells, range(32) AS r(s) GROUP BY ALL
), f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
  SELECT filter_order, step::int AS step, 1 << (ascii(filter_order[step]) - 65) AS bit,
         list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65)))::int AS earlier
  FROM orders, range(1, 6) AS r(step)
), out AS (
  SELECT b.part, filter_order, step, bit, a.n AS kept, b.n - a.n AS removed, z.n - o.n - (b.n - a.n) AS redundant,
         x.n - y.n AS unique_fails, b.g - a.g AS good_lost, b.t - a.t AS toxic_lost
  FROM steps
  JOIN sets b ON b.s = coalesce(earlier, 0)
  JOIN sets a ON a.part = b.part AND a.s = b.s + bit
  JOIN sets z ON z.part = b.part AND z.s = 0
  JOIN sets o ON o.part = b.part AND o.s = bit
  JOIN sets x ON x.part = b.part AND x.s = 31 - bit
  JOIN sets y ON y.part = b.part AND y.s = 31
)
SELECT part, filter_order, step, kept::bigint AS kept, removed::bigint AS removed, redundant::bigint AS redundant,
       unique_fails::bigint AS unique_fails, good_lost::bigint AS good_lost, toxic_lost::bigint AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::bigint AS shapley
FROM out
"""
