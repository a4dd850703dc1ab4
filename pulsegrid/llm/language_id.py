"""Language ID by rank-order n-gram profiles.

A language's profile is its most frequent character n-grams (one to three characters), by
rank. A document's own most frequent n-grams are ranked the same way, and each contributes how
far out of place it stands in a profile; a missing one counts as far out as the profile is
long. The language with the smallest total distance wins.

The filter of a pipeline goes by the result: what has no language goes, and so does what is
written in a script that training has not met, or stands much further from its language than
any training text of that language and about that length does. A row without a language gets
the one that was found.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import RUN_BYTES, bounded_arrow_batches, byte_slices, documents, id_residue, released, stage

# Length of a profile: the n-grams kept of a language, and the most compared of a document.
PROFILE = 300

UNDETERMINED = "und"

# Training texts of one language and length class that it takes to say how far its texts stand;
# classes with fewer reject nothing.
LEAST_SEEN = 30

# A text is too far off when it is not even this share as close as the farthest of them.
FAR = 0.5

# Rows to change that are broadcast, and joined by shuffle beyond.
BROADCAST_ROWS = 1 << 20

# Grams of three characters: each character takes 21 bits, 0 where there is none, 1 for the
# break between two words. A code point is stored as itself + 2.
_BITS = np.uint64(21)
_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def script(point: int) -> str:
    """What a letter is written in: the first word of its Unicode name, as LATIN or CJK; full-width, raised, mathematical and
    other compatibility letters go by the letter they stand for."""
    letter = unicodedata.normalize("NFKC", chr(point))[:1]
    return unicodedata.name(letter, "").partition(" ")[0]


def gram_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(grams, first, letters): small numbers of all n-grams of the texts, text by text, where
    each text's begin, and the alphabet that turns the numbers into codes (see `codes`).

    Letters are lower-cased; any run of other characters is one break, and each text has one
    at its start and its end. Grams of breaks alone are left out.
    """
    lowered = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32)
    ends = np.cumsum([0, *map(len, lowered)])
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of a run of other characters only the first
    keep[ends[:-1]] = True
    seen = np.zeros(0x110000, bool)
    seen[points[letter]] = True
    letters = np.flatnonzero(seen)
    number = np.zeros(0x110000, np.uint64)
    number[letters] = np.arange(2, len(letters) + 2)
    chars = np.where(letter, number[points], np.uint64(1))[keep]
    kept = np.concatenate([[0], np.cumsum(keep)])[ends]
    base = np.uint64(len(letters) + 2)
    small = np.uint32 if int(base) ** 3 < 1 << 32 else np.uint64
    n = len(chars)
    two, three = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    two[:-1], three[:-2] = chars[1:], chars[2:]
    left = np.repeat(kept[1:], np.diff(kept)) - np.arange(n)  # characters up to the text's end
    one = chars > 1
    pair = (left >= 2) & (one | (two > 1))
    triple = left >= 3
    triple &= one | (two > 1) | (three > 1)
    of = np.repeat(np.arange(len(texts)), np.diff(kept))
    first_code = chars * base * base
    runs, owner = [], []
    for mask, value in ((one, first_code), (pair, first_code + two * base),
                        (triple, first_code + two * base + three)):
        runs.append(value[mask].astype(small))
        owner.append(of[mask])
    counts = sum(np.bincount(o, minlength=len(texts)) for o in owner)
    first = np.concatenate([[0], np.cumsum(counts)])
    grams = np.empty(first[-1], small)
    at = first[:-1].copy()
    for run, own in zip(runs, owner, strict=True):
        c = np.bincount(own, minlength=len(texts))
        grams[np.repeat(at - (np.cumsum(c) - c), c) + np.arange(len(run))] = run
        at += c
    return grams, first, letters


def codes(grams: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Numbers of one run of texts as codes that mean the same everywhere, in the same order."""
    base = np.uint64(len(letters) + 2)
    point = np.concatenate([[0, 1], letters + 2]).astype(np.uint64)
    g = grams.astype(np.uint64)
    return (point[g // (base * base)] << (_BITS + _BITS)) | (point[g // base % base] << _BITS) | point[g % base]


def _most_frequent(grams: np.ndarray) -> np.ndarray:
    """The PROFILE most frequent, most frequent first, ties by gram."""
    grams = np.sort(grams)
    edge = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    counts = np.diff(np.append(edge, len(grams)))
    if len(counts) > PROFILE:  # only those that can be among the first
        least = np.partition(counts, len(counts) - PROFILE)[len(counts) - PROFILE]
        edge, counts = edge[counts >= least], counts[counts >= least]
    return grams[edge[np.argsort(-counts, kind="stable")[:PROFILE]]]


def _text_runs(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    for a, b, _, _ in byte_slices(texts, RUN_BYTES):
        yield a, texts.slice(a, b - a).to_pylist()


def gram_counts(df: DataFrame) -> DataFrame:
    """(lang, gram, n) of the rows (text, lang): what each task counted, summed."""
    bounded_arrow_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for a, texts in _text_runs(batch.column(0)):
                grams, first, letters = gram_runs(texts)
                own = langs[a:a + len(texts)]
                for lang in sorted(set(own)):
                    mine = np.concatenate([grams[first[i]:first[i + 1]] for i in np.flatnonzero(own == lang)])
                    if (len(letters) + 2) ** 3 <= 1 << 24:
                        n = np.bincount(mine)
                        value = np.flatnonzero(n)
                        n = n[value]
                    else:
                        value, n = np.unique(mine, return_counts=True)
                    code = codes(value, letters)
                    if lang in total:
                        code = np.concatenate([total[lang][0], code])
                        code, where = np.unique(code, return_inverse=True)
                        n = np.bincount(where, np.concatenate([total[lang][1], n])).astype(np.int64)
                    total[lang] = code, n
                    if len(code) > 1 << 20:
                        yield _counts_batch(lang, *total.pop(lang))
        for lang, (code, n) in total.items():
            yield _counts_batch(lang, code, n)

    counted = df.mapInArrow(released(run), "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _counts_batch(lang: str, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(code), pa.string()), pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64))],
        names=["lang", "gram", "n"])


class Profiles:
    """The trained model: for each gram of any profile, the languages that have it and its rank
    there. PROFILE numbers a language, so it may travel with the tasks, as may the scripts of
    the letters met in training: there are fewer than Unicode has letters."""

    def __init__(self, rows: list[tuple[str, int, int]], letters: Iterable[int] = ()):
        self.scripts = frozenset(map(script, letters))
        self.langs = sorted({lang for lang, _, _ in rows})
        number = {lang: i for i, lang in enumerate(self.langs)}
        gram = np.array([g for _, g, _ in rows], np.uint64)
        order = np.argsort(gram, kind="stable")
        self.grams, first = np.unique(gram[order], return_index=True)
        self.first = np.append(first, len(order))
        self.of = np.array([number[lang] for lang, _, _ in rows], np.int64)[order]
        self.rank = np.array([rank for _, _, rank in rows], np.int64)[order]

    def predict(self, top: np.ndarray) -> tuple[str, float]:
        """Language of a document whose most frequent grams are ``top``, and its closeness: 1
        when all stand in place, 0 when none is in the profile."""
        if not len(top) or not self.langs:
            return UNDETERMINED, 0.0
        at = np.minimum(np.searchsorted(self.grams, top), len(self.grams) - 1)
        place = np.flatnonzero(self.grams[at] == top)
        begin, many = self.first[at[place]], np.diff(self.first)[at[place]]
        entry = np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())
        # What a gram that is found takes off the distance of a missing one.
        saved = PROFILE - np.abs(self.rank[entry] - np.repeat(place, many))
        apart = PROFILE * len(top) - np.bincount(self.of[entry], saved, len(self.langs))
        best = int(np.argmin(apart))
        return self.langs[best], 1.0 - float(apart[best]) / (PROFILE * len(top))


def _known_letters(profiles: Profiles) -> np.ndarray:
    """For each code point whether it is a letter of a script that the training rows are written in."""
    known = np.zeros(0x110000, bool)
    if profiles.langs:
        letters = np.flatnonzero(_letters())
        known[letters] = [script(p) in profiles.scripts for p in letters.tolist()]
    return known


def in_known_script(texts: list[str], known: np.ndarray) -> np.ndarray:
    """For each text whether any of its letters is known."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    upto = np.concatenate([[0], np.cumsum(known[points], dtype=np.int64)])[np.cumsum([0, *map(len, texts)])]
    return upto[1:] > upto[:-1]


def learn_profiles(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles of all languages in ``df``; rows with a null text or language teach nothing."""
    rows = df.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    counts = stage(df.sparkSession, gram_counts(rows.where("text is not null and lang is not null")), "gram-counts")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < PROFILE)
    point = F.shiftright("gram", 2 * int(_BITS)).cast("int") - 2
    alone = F.col("gram").bitwiseAND(F.lit((1 << 2 * int(_BITS)) - 1)) == 0
    letters = counts.where(alone).select(point.alias("point")).distinct().collect()
    return Profiles([(r.lang, r.gram, r["rank"]) for r in top.select("lang", "gram", "rank").collect()],
                    [r.point for r in letters])


def _found(narrow: DataFrame, profiles: Profiles) -> DataFrame:
    """(id, lang_pred, score, n_grams, known_script) of the rows (id, text)."""
    bounded_arrow_batches(narrow.sparkSession)
    schema = T.StructType([narrow.schema["id"], *T.StructType.fromDDL(
        "lang_pred string, score double, n_grams long, known_script boolean").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known_letters(profiles)
        for batch in batches:
            found: list[tuple[str, float]] = []
            n_grams, known_script = [], []
            for _, nullable in _text_runs(batch.column(1)):
                texts = [t or "" for t in nullable]
                grams, first, letters = gram_runs(texts)
                for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                    found.append(profiles.predict(codes(_most_frequent(grams[a:b]), letters)) if a < b else (UNDETERMINED, 0.0))
                n_grams.extend(np.diff(first).tolist())
                known_script.extend(in_known_script(texts, known).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64()),
                 pa.array(n_grams, pa.int64()), pa.array(known_script, pa.bool_())],
                names=["id", "lang_pred", "score", "n_grams", "known_script"])

    return narrow.mapInArrow(released(run), schema)


def identify(df: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, lang_pred, score) for every row of ``df``, from the whole text alone.

    A null text and one without letters are ``und`` with score 0, as is everything when no
    language was learned. Any other text gets a learned language, the first by name where
    distances are equal, even if it has no gram in common with any (score 0). Repeated rows,
    null ids and further columns are left as they are or not read.
    """
    narrow = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return _found(narrow, profiles).select(F.col("id").alias(id_col), "lang_pred", "score")


def _length_class(n_grams: str = "n_grams") -> Column:
    """Texts of about the same length: by powers of two."""
    return F.floor(F.log2(F.col(n_grams))).cast("int")


def least_closeness(df: DataFrame, profiles: Profiles, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang_pred, length_class, least): the least closeness of the training texts of a language
    and length class that were found to be in that language, for classes of LEAST_SEEN texts
    or more. One row a language and class: a class is a power of two."""
    rows = df.select(F.col(f"`{lang_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = _found(rows.where("id is not null and text is not null"), profiles).where("id = lang_pred and n_grams > 0")
    seen = found.groupBy("lang_pred", _length_class().alias("length_class")).agg(F.min("score").alias("least"), F.count("*").alias("n"))
    return stage(df.sparkSession, seen.where(F.col("n") >= LEAST_SEEN).drop("n"), "least-closeness")


def keep_identified(df: DataFrame, profiles: Profiles, least: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The rows of ``df`` that are in a language of the training rows, all columns as they are
    but for ``lang_col``: where it is null it becomes the language found.

    Rejected are ``und``; texts without a letter of a script met in training; and texts not
    FAR as close to the language found as ``least`` (see :func:`least_closeness`) has for their
    length. Only ids and texts pass through Python; what must change is a list of (id, hash of
    the text), joined to the rows. Rows equal in both are treated alike.
    """
    spark = df.sparkSession
    key = F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("h"), F.col(f"`{lang_col}`").isNull().alias("no_lang"))
    found = _found(df.select(key.alias("id"), F.col(f"`{text_col}`").alias("text")), profiles)
    judged = found.withColumn("length_class", _length_class()).join(least, ["lang_pred", "length_class"], "left")
    far = F.coalesce(F.col("score") < F.col("least") * FAR, F.lit(False))
    judged = judged.select("id.*", "lang_pred", ((F.col("lang_pred") == UNDETERMINED) | ~F.col("known_script") | far).alias("gone"))
    change = stage(spark, judged.where("gone or no_lang").distinct(), "language-changes").select(
        F.col("id").alias("_id"), F.col("h").alias("_h"), F.col("no_lang").alias("_none"), F.col("lang_pred").alias("_lang"), F.col("gone").alias("_gone"))
    few = change.count() <= BROADCAST_ROWS
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("whole"), key.alias("key"))  # no name of it can clash
    same = (F.col("key.h") == F.col("_h")) & F.col("key.id").eqNullSafe(F.col("_id")) & (F.col("key.no_lang") == F.col("_none"))
    kept = rows.join(F.broadcast(change) if few else change.hint("merge"), same, "left").where(~F.coalesce("_gone", F.lit(False)))
    lang = F.coalesce(F.col("whole").getField(lang_col), F.col("_lang").cast(df.schema[lang_col].dataType))
    return kept.select(*((lang if c == lang_col else F.col("whole").getField(c)).alias(c) for c in df.columns))


def held_out(doc_id: Column) -> Column:
    """The documents nothing is learned from: crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(id_residue(doc_id, 3) == 1, F.lit(False))


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    profiles = learn_profiles(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, profiles).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
