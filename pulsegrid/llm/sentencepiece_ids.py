"""SentencePiece encoding and decoding through a table of distinct marked words.

When no piece of the model runs across the start of a whitespace marker, every marked word (a
run of markers and the letters after it) is segmented on its own, whatever stands around it.
So each task keeps a table of the distinct marked words it met, lets the library segment each
of them once, and joins the ids back by position. A model that does not allow this has its
texts segmented whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_arrow_batches, byte_slices, documents

# Entries after which a task starts its table anew: a bound on memory, not on the words.
TABLE_WORDS = 1 << 18

MARKER = "▁"
_MARKED = re.compile(f"[ {MARKER}]+[^ {MARKER}]*")


class WordTable:
    """Segments texts with a library model, each distinct marked word once."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.by_word = splits_at_markers(self.sp)
        self._reset()

    def _reset(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def _segment(self, words: list[str]) -> list[list[int]]:
        """The library puts one marker before a text; a word gives up its own first one. It
        would put none before an empty text, so a lone marker is encoded by its piece."""
        pieces = self.sp.encode([w[1:] for w in words], num_threads=1)
        lone = self.sp.piece_to_id(MARKER)
        return [p if len(w) > 1 else [lone] for w, p in zip(words, pieces, strict=True)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids start."""
        if not self.by_word:
            each = self.sp.encode(texts, num_threads=1)
            ends = np.cumsum([0, *map(len, each)])
            return np.fromiter((i for x in each for i in x), np.int32, ends[-1]), ends
        if len(self.number) > TABLE_WORDS:
            self._reset()
        number, before = self.number, len(self.number)
        rows = [_MARKED.findall(" " + t) if t else [] for t in texts]
        order = np.fromiter(
            (number.setdefault(w, len(number)) for row in rows for w in row), np.int64, sum(map(len, rows)))
        if len(number) > before:
            fresh = self._segment(list(number)[before:])
            lengths = np.fromiter(map(len, fresh), np.int64, len(fresh))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate(
                [self.ids, np.fromiter((i for x in fresh for i in x), np.int32, int(lengths.sum()))])
        lengths = self.lengths[order]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.ids[np.repeat(self.starts[order] - ends[:-1], lengths) + np.arange(ends[-1])]
        words = np.cumsum([0, *map(len, rows)])
        return ids, ends[words]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        flat = ids.tolist()
        return self.sp.decode([flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]) if len(ends) > 1 else []


def splits_at_markers(sp) -> bool:
    """Whether texts may be cut before every run of markers: no piece has a marker after a
    letter, the lone marker is a piece, and the model leaves white space as it is."""
    for i in range(sp.vocab_size()):
        if re.search(f"[^{MARKER}]{MARKER}", sp.id_to_piece(i)):
            return False
    probe = "a  b " + MARKER + " c"
    kept = "".join(sp.id_to_piece(i) for i in sp.encode(probe))
    return kept == MARKER + probe.replace(" ", MARKER) and sp.id_to_piece(sp.piece_to_id(MARKER)) == MARKER


def encode_decode(df: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ids, decoded) for every row of ``df``.

    ``ids`` is what the library's ``encode`` gives for the whole text, without begin or end
    ids or sampling; ``decoded`` is its ``decode`` of these ids. A null text counts as empty:
    no ids, an empty string. Repeated rows come out once each, null ids stay null, an empty
    table gives an empty result, and no other column is read.
    """
    bounded_arrow_batches(df.sparkSession)
    narrow = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    schema = T.StructType([
        narrow.schema["id"],
        T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("decoded", T.StringType(), False),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            table = table or WordTable(model_file)
            for a, b, _, _ in byte_slices(batch.column(1)):
                ids, ends = table.encode(batch.column(1).slice(a, b - a).to_pylist())
                decoded = table.decode(ids, ends)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), lists, pa.array(decoded, pa.string())],
                    names=["id", "ids", "decoded"])

    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_sentencepiece(spark, sf_dir: str) -> DataFrame:
    coded = encode_decode(documents(spark, sf_dir), model_path())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
