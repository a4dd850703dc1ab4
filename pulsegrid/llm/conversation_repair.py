"""Conversation structure repair: the cheapest edits that give every conversation the turn order
``(s?(ua)+)?``, by an integer-minimum DP over scalar weights.

A weight is one big integer. Its high digits are the cost of the edits; its low digits, of a
fixed width, are their audit letters from the left, with zeros behind the last. So ordinary
integer order is order by cost, then by audit in ASCII. The DP goes through a conversation from
its last turn to its first. Putting an edit in front of a weight adds the edit's cost to the
high digits, moves the low digits down one place and sets the first. The nodes are (turn,
state), four states a turn: nothing said yet, system said, user said, assistant said.

Turns are taken in blocks, so that weights stay short in long conversations: what lies behind a
block enters as one digit, its rank among the four states. That is exact, as every path through
a block has one row letter for each of its turns and ends with one, so no audit of a block is
the beginning of another.

Faults are found in Spark. Per conversation, one task sees a byte for each turn, in order; the
texts pass that task's successor as a sorted stream beside the audit and are never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_arrow_batches, stage

# Fixed values of the contract: costs of the edits, what ends a sentence, what is white space.
RETAG_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
SENTENCE_END = ".!?"
BLANKS = " \t\n\x0b\x0c\r"

# A letter's digit; 0 is the padding behind the end.
LETTERS = " DIKR"
DELETE, INSERT, KEEP, RETAG = (LETTERS.index(c) for c in "DIKR")
DIGIT_BITS = 3

# States, and the one that a user or assistant turn leads to.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}

# What the byte of a turn says: its role's initial (0: none of s, u, a), that it must go, that
# it is cut off.
INITIAL, MUST_GO, CUT_OFF = 3, 4, 8
BLANK, REPEATED = 16, 32

# Turns in one block of the DP.
BLOCK_TURNS = 256

# Rows in one batch out of a Python worker, and the text characters that end it earlier.
OUT_ROWS = 1 << 14
OUT_CHARS = 4 << 20


def _block(turns: bytes, after: list[int], width: int) -> list[int]:
    """The weights of the four states before ``turns``, from those behind them. ``width`` is
    the number of low bits."""
    low = (1 << width) - 1

    def edit(cost: int, letter: int) -> int:
        return (cost << width) + (letter << width - DIGIT_BITS)

    def put(weight: int, added: int) -> int:
        return weight - (at := weight & low) + (at >> DIGIT_BITS) + added

    delete, insert = edit(DELETE_COST, DELETE), edit(INSERT_COST, INSERT)
    keep = (edit(0, KEEP), edit(TRUNCATED_COST, KEEP))
    retag = (edit(RETAG_COST, RETAG), edit(RETAG_COST + TRUNCATED_COST, RETAG))
    for turn in reversed(turns):
        here = [put(w, delete) for w in after]
        if not turn & MUST_GO:
            cut = bool(turn & CUT_OFF)
            for state, said in enumerate(NEXT):
                here[state] = min(here[state], put(after[said], retag[cut]))
                if turn & INITIAL == said:
                    here[state] = min(here[state], put(after[said], keep[cut]))
            if turn & INITIAL == SYSTEM:
                here[NOTHING] = min(here[NOTHING], put(after[SYSTEM], keep[cut]))
        # In front of the turn: no insertion, one, or two where two lead to a new state.
        user, assistant = put(here[USER], insert), put(here[ASSISTANT], insert)
        both = put(assistant, insert)
        after = [min(here[NOTHING], user, both), min(here[SYSTEM], user, both),
                 min(here[USER], assistant), min(here[ASSISTANT], user)]
    return after


def _letters(digits: int, width: int) -> list[int]:
    out = []
    for at in range(width - DIGIT_BITS, -1, -DIGIT_BITS):
        if not (digit := digits >> at & 7):
            break
        out.append(digit)
    return out


def cheapest_edits(turns: bytes, block_turns: int = 0) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a conversation given as one byte a turn."""
    block_turns = block_turns or BLOCK_TURNS
    starts = list(range(0, len(turns), block_turns))
    width = DIGIT_BITS * (3 * min(block_turns, len(turns)) + 2)
    low = (1 << width) - 1
    # Behind the last turn: what is missing for the pattern is inserted.
    missing = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
    after = [(INSERT_COST * n << width) + sum(INSERT << width - DIGIT_BITS * (k + 1) for k in range(n))
             for n in missing.values()]
    blocks = []
    for start in reversed(starts):
        before = _block(turns[start:start + block_turns], after, width)
        ranked = sorted(range(4), key=lambda s: before[s] & low)
        blocks.append(([w & low for w in before], ranked))
        after = [0] * 4
        for rank, s in enumerate(ranked, 1):
            after[s] = (before[s] >> width << width) + (rank << width - DIGIT_BITS)
    audit, state = [], NOTHING
    for k in range(len(blocks) - 1, -1, -1):
        found = _letters(blocks[k][0][state], width)
        if k:
            state = blocks[k - 1][1][found.pop() - 1]
        audit.extend(found)
    return after[NOTHING] >> width, "".join(LETTERS[d] for d in audit)


def _spaced(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(" "))


def _turns(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest) with nulls of role and text as one space."""
    role, text = _spaced(F.col("role")), _spaced(F.col("text"))
    return df.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                     F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))


def _marked(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, mark): the byte of every turn. A turn with a role and text
    that an earlier turn number has is repeated; repeats within one turn number lie next to
    each other in order and are left to the stream."""
    spark = turns.sparkSession
    ending = F.rtrim(F.col("text"), F.lit(BLANKS))
    blank = F.length(ending) == 0
    initial = F.left("role", F.lit(1))
    mark = (
        F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(0)
        + F.when(blank, MUST_GO + BLANK)
        .when(F.right(ending, F.lit(1)).isin(*SENTENCE_END), 0).otherwise(CUT_OFF))
    rows = stage(spark, turns.select("conv_id", "turn", "role", "digest", mark.alias("mark")), "turn-marks")
    number = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn"))
    first = rows.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min(number).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    return rows.join(first, same).select(
        "conv_id", "turn", "role", "digest",
        F.when(number > F.col("first"), F.col("mark").bitwiseOR(F.lit(REPEATED))).otherwise(F.col("mark")).alias("mark"))


def _in_order(df: DataFrame, *first: str) -> DataFrame:
    """Every conversation in one partition, its rows one after another: by turn (null first),
    role, digest of the text."""
    return df.repartition("conv_id").sortWithinPartitions(
        "conv_id", *first, F.col("turn").asc_nulls_first(), "role", "digest")


AUDIT_COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_NEVER = object()


class _Conversation:
    """What is kept of a conversation while its turns pass: a byte for each, and counts."""

    def __init__(self):
        self.turns = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.numbers = 0
        self.least = self.most = None
        self.last = None

    def add(self, turn, role, digest, mark: int) -> None:
        key = (turn, role, digest)
        if mark & BLANK:
            self.blank += 1
        elif mark & REPEATED or key == self.last:
            mark |= MUST_GO
            self.duplicate += 1
        elif mark & CUT_OFF:
            self.truncated += 1
        if self.turns:
            pair = self.turns[-1] & INITIAL, mark & INITIAL
            self.illegal += pair not in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))
        if turn is not None and turn != self.most:
            self.numbers += 1
            self.least, self.most = turn if self.least is None else self.least, turn
        self.turns.append(mark & 15)
        self.last = key

    def result(self) -> tuple:
        cost, audit = cheapest_edits(bytes(self.turns))
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.numbers
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, at = None, _NEVER
    ids: list = []
    done: list[tuple] = []

    def out(kind: pa.DataType) -> pa.RecordBatch:
        *numbers, audits = zip(*done, strict=True)
        return pa.record_batch([pa.array(ids, kind), *(pa.array(n, pa.int64()) for n in numbers), pa.array(audits, pa.string())],
                               names=["conv_id", *AUDIT_COLUMNS, "audit"])

    kind = None
    for batch in batches:
        kind = batch.column("conv_id").type
        for conv, *turn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or conv != at:
                if now is not None:
                    ids.append(at)
                    done.append(now.result())
                    if len(done) >= OUT_ROWS or len(done[-1][-1]) >= OUT_CHARS:
                        yield out(kind)
                        ids, done = [], []
                now, at = _Conversation(), conv
            now.add(*turn)
    if now is not None:
        ids.append(at)
        done.append(now.result())
        yield out(kind)


def audit_conversations(df: DataFrame) -> DataFrame:
    """Faults of every conversation of ``df`` (conv_id, turn, role, text) and its cheapest repair.

    Returns one row per conv_id: gaps (turn numbers missing between the least and the greatest,
    0 if all are null), blank, duplicate, truncated (turns by their first fault), illegal
    (neighbours whose role initials are not su, ua or au), cost, and audit: the edits' initials
    in order (Delete, Insert, Keep, Rerole), the least in ASCII of the cheapest. Blank and
    duplicate turns must go.

    Turns come by number, null first; within one number by role, then by the SHA-256 of their
    text. Null roles and texts are one space. A null conv_id is a conversation like any other.
    An empty table has no conversations. Columns of other names are not read.
    """
    bounded_arrow_batches(df.sparkSession)
    kind = T.StructType([T.StructField("conv_id", df.schema["conv_id"].dataType), *T.StructType.fromDDL(
        ", ".join(f"{c} long" for c in AUDIT_COLUMNS) + ", audit string").fields])
    return _in_order(_marked(_turns(df))).select("conv_id", "turn", "role", "digest", "mark").mapInArrow(_audits, kind)


class _Repair:
    """Applies an audit to the turns that it speaks of, as they pass."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.position = audit, 0, NOTHING, 0

    def _say(self, edit: str, role: str, text: str) -> tuple:
        self.position += 1
        return self.position, edit, role, text

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            yield self._say("I", ROLE_OF[self.state], "")

    def turn(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self.state = SYSTEM if edit == "K" and role[:1] == "s" else NEXT[self.state]
            yield self._say(edit, role if edit == "K" else ROLE_OF[self.state], text)


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit rows (kind 0) and the turns behind each (kind 1) to the turns of the repair."""
    now, at, kind, chars = None, None, None, 0
    rows: list[tuple] = []

    def out() -> pa.RecordBatch:
        ids, position, edit, role, text = zip(*rows, strict=True)
        return pa.record_batch([pa.array(ids, kind), pa.array(position, pa.int64()), pa.array(edit, pa.string()),
                                pa.array(role, pa.string()), pa.array(text, pa.string())],
                               names=["conv_id", "position", "edit", "role", "text"])

    for batch in batches:
        kind = batch.column("conv_id").type
        for conv, is_turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if is_turn:
                said = now.turn(role, text)
            else:
                said, next_one, before = (now.inserted() if now else ()), _Repair(text), at
            for row in said:
                rows.append((conv if is_turn else before, *row))
                chars += len(row[-1])
            if not is_turn:
                now, at = next_one, conv
            if len(rows) >= OUT_ROWS or chars >= OUT_CHARS:
                yield out()
                rows, chars = [], 0
    if now:
        rows.extend((at, *row) for row in now.inserted())
    if rows:
        yield out()


def _repair_input(df: DataFrame, audits: DataFrame) -> DataFrame:
    """The audit of every conversation, then its turns in order."""
    turns = _turns(df).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text")
    heads = audits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                          F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"),
                          F.col("audit").alias("text"))
    return _in_order(heads.unionByName(turns), "kind").select("conv_id", "kind", "role", "text")


def repaired_turns(df: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (from 1), edit, role, text.

    ``audits`` is what :func:`audit_conversations` returned for ``df``. Kept turns have their
    role and text, reroled ones a new role, inserted ones an empty text. A conversation that is
    repaired to nothing has no rows."""
    bounded_arrow_batches(df.sparkSession)
    kind = T.StructType([T.StructField("conv_id", df.schema["conv_id"].dataType), *T.StructType.fromDDL(
        "position long, edit string, role string, text string").fields])
    return _repair_input(df, audits).mapInArrow(_repairs, kind)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of every conversation's ``role:text`` lines, fed to the hash as they pass."""
    running, at, kind = None, None, None
    ids: list = []
    hashes: list[str] = []
    for batch in _repairs(batches):
        kind = batch.column("conv_id").type
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "position", "role", "text"))
        for conv, position, role, text in zip(*columns, strict=True):
            if position == 1:
                if running is not None:
                    ids.append(at)
                    hashes.append(running.hexdigest())
                running, at = sha256(), conv
            else:
                running.update(b"\n")
            running.update(f"{role}:{text}".encode())
        if ids:
            yield pa.record_batch([pa.array(ids, kind), pa.array(hashes, pa.string())], names=["conv_id", "repaired_sha256"])
            ids, hashes = [], []
    if running is not None:
        yield pa.record_batch([pa.array([at], kind), pa.array([running.hexdigest()], pa.string())],
                              names=["conv_id", "repaired_sha256"])


def repaired_digests(df: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of :func:`repaired_turns`, each conversation's rows as lines
    ``role:text``; conversations that are repaired to nothing have no row."""
    bounded_arrow_batches(df.sparkSession)
    kind = T.StructType([T.StructField("conv_id", df.schema["conv_id"].dataType),
                         T.StructField("repaired_sha256", T.StringType())])
    return _repair_input(df, audits).mapInArrow(_digests, kind)


def damaged(df: DataFrame) -> DataFrame:
    """The contract's damage to conversations: by crc32(``conv_id:turn``) % 20 a turn is lost
    (0), emptied (1), loses its sentence ends (2), is said twice (3) or put in the user's
    mouth (4). Nulls, in that text too, are one space; a null turn number stays null."""
    fate = F.crc32(F.concat_ws(":", _spaced(F.col("conv_id")), _spaced(F.col("turn"))).cast("binary")) % 20
    role, text = _spaced(F.col("role")), _spaced(F.col("text"))
    return df.select(
        "conv_id", "turn", fate.alias("fate"), F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, SENTENCE_END, "")).otherwise(text).alias("text"),
    ).where("fate <> 0").select(
        "conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1)))
    ).select("conv_id", "turn", "role", "text")


def repair_summary(conversations: DataFrame) -> DataFrame:
    """The contract's columns for every conv_id of ``conversations``, damaged, audited, repaired."""
    spark = conversations.sparkSession
    turns = damaged(conversations)
    audits = stage(spark, audit_conversations(turns), "conversation-audits")
    digests = repaired_digests(turns, audits).withColumnRenamed("conv_id", "digest_id")
    ids = conversations.groupBy("conv_id").agg(F.lit(1).alias("one"))
    audits = audits.withColumnRenamed("conv_id", "audit_id")
    found = ids.join(audits, F.col("conv_id").eqNullSafe(F.col("audit_id")), "left") \
        .join(digests, F.col("conv_id").eqNullSafe(F.col("digest_id")), "left")
    return found.select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in AUDIT_COLUMNS),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(sha256(b"").hexdigest())).alias("repaired_sha256"))


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair_summary(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


# DuckDB has no crc32: it is spelled out bit by bit. The DP goes forward, a turn a round, and
# carries (cost, audit, text) of the best path to each state.
OP12_SQL = r"""
WITH RECURSIVE fates AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(list_concat([4294967295], list_transform(
             string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ascii(c)::bigint)),
           lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
             lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS fate
  FROM conversations
), turns AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE fate WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM fates WHERE fate <> 0)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, role[1] AS initial,
               regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS ending FROM turns)
), marked AS (
  SELECT conv_id, turn, i, role, text, initial, ending = '' AS blank, ending <> '' AND nth > 1 AS duplicate,
         ending <> '' AND nth = 1 AND ending NOT IN ('.', '!', '?') AS truncated,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM numbered
), gap(q, m, letters, cost, said) AS (
  VALUES (0, 0, '', 0, ''), (1, 1, '', 0, ''), (2, 2, '', 0, ''), (3, 3, '', 0, ''),
         (0, 2, 'I', 2, chr(10) || 'user:'), (1, 2, 'I', 2, chr(10) || 'user:'), (3, 2, 'I', 2, chr(10) || 'user:'),
         (2, 3, 'I', 2, chr(10) || 'assistant:'), (0, 3, 'II', 4, chr(10) || 'user:' || chr(10) || 'assistant:'),
         (1, 3, 'II', 4, chr(10) || 'user:' || chr(10) || 'assistant:')
), edit(m, letter, initial, q, cost, role) AS (
  VALUES (0, 'D', NULL, 0, 3, NULL), (1, 'D', NULL, 1, 3, NULL), (2, 'D', NULL, 2, 3, NULL), (3, 'D', NULL, 3, 3, NULL),
         (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (3, 'K', 'u', 2, 0, NULL),
         (2, 'K', 'a', 3, 0, NULL), (0, 'R', NULL, 2, 2, 'user'), (1, 'R', NULL, 2, 2, 'user'), (3, 'R', NULL, 2, 2, 'user'),
         (2, 'R', NULL, 3, 2, 'assistant')
), moves AS (
  SELECT g.q AS q, e.q AS q2, g.letters || e.letter AS letters, g.cost + e.cost AS cost, g.said, e.letter, e.initial, e.role
  FROM gap g JOIN edit e USING (m)
), paths AS (
  SELECT DISTINCT conv_id, 0::bigint AS i, 0 AS q, {'cost': 0::bigint, 'audit': '', 'text': ''} AS best FROM turns
  UNION ALL
  SELECT p.conv_id, p.i + 1, v.q2, min({
           'cost': p.best.cost + v.cost + CASE WHEN t.truncated AND v.letter <> 'D' THEN 1 ELSE 0 END,
           'audit': p.best.audit || v.letters,
           'text': p.best.text || v.said || CASE v.letter WHEN 'D' THEN '' ELSE chr(10) || coalesce(v.role, t.role) || ':' || t.text END})
  FROM paths p JOIN marked t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1
  JOIN moves v ON v.q = p.q AND (v.letter = 'D' OR NOT (t.blank OR t.duplicate) AND (v.letter = 'R' OR v.initial = t.initial))
  GROUP BY p.conv_id, p.i, v.q2
), ends AS (
  SELECT p.conv_id, min({'cost': p.best.cost + g.cost, 'audit': p.best.audit || g.letters, 'text': p.best.text || g.said}) AS best
  FROM paths p JOIN (SELECT conv_id, max(i) AS n FROM marked GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM p.conv_id AND l.n = p.i
  JOIN gap g ON g.q = p.q AND g.m IN (0, 3) GROUP BY p.conv_id
), faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM marked GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::bigint AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::bigint AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(best.text[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
