"""Best-fit packing of tokenized documents (operator 1).

``tokenized_pieces`` encodes every document and cuts it into pieces of at most
``size`` tokens. ``pack`` places the pieces by bounded-space online best fit: a
fixed number of bins is open at a time, a bitset keyed by free space finds the
fullest bin that still takes the piece, and when no bin takes it and all are
open, the fullest one closes. Pieces arrive in no order of length: sorted ones,
longest first, would pack as well only with thousands of open bins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import values, written
from .wordbpe import word_bpe

SIZE = 2048
# Open bins of a task.
OPEN_BINS = 64
# Sequences a task fills on average. Some tens of its open bins stay partly empty at
# the end, so the more sequences, the smaller their share; a piece is a few numbers.
TASK_SEQUENCES = 1 << 15
SEPARATOR = b"\0\0\0\0"  # id 0 ends each document

PIECE_SCHEMA = "piece int, start long, length long, ids_crc32 long"


def tokenized_pieces(
    df: DataFrame, tokenizer: str, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, with
    ``keep_ids``, ``ids`` (little-endian unsigned 32-bit).

    A document is its ids and then id 0; null and empty texts are id 0 alone,
    so every row gives at least one piece. Only documents longer than ``size``
    are cut. Whole texts are encoded.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer)
        for batch in batches:
            row, piece, start, length, crc, packed = [], [], [], [], [], []
            for k, text in enumerate(values(batch, "text")):
                ids = bpe.encode_packed(text) + SEPARATOR
                for n, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    row.append(k)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        packed.append(part)
            columns = [
                batch.column("doc_id").take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(packed, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {id_type}, {PIECE_SCHEMA}" + ", ids binary" * keep_ids)


class OpenBins:
    """The open bins of one task."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.count, self.opened = size, most, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.free_bits = 0  # bit f is set while a bin with f free places is open

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.free_bits ^= 1 << free
        self.count -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of 1 to ``size`` tokens."""
        fitting = self.free_bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.count == self.most:
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)  # the fullest closes
            free, number = self.size, self.opened
            self.opened += 1
        left = free - length
        if left:  # a full bin closes by itself
            self.by_free[left].append(number)
            self.free_bits |= 1 << left
            self.count += 1
        return number, self.size - free


def best_fit(lengths: Iterable[int], size: int = SIZE, open_bins: int = OPEN_BINS) -> list[tuple[int, int]]:
    """(bin, offset) of each length, in the given order."""
    bins = OpenBins(size, open_bins)
    return [bins.place(n) for n in lengths]


def pack(pieces: DataFrame, size: int = SIZE, open_bins: int = OPEN_BINS, task_sequences: int = TASK_SEQUENCES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``pieces`` must be a
    written table, as it is read twice.

    The number of tasks follows the number of tokens, about ``task_sequences``
    sequences each, so a task's rows stay bounded at any input size and only the
    open bins of its end remain partly filled. Only the pieces' numbers are
    shuffled, evenly, so neither a hot source nor copies weigh on one task; in a
    task they come in the order of a hash, the same in every run.
    An empty table gives an empty result.
    """
    tokens = pieces.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-tokens // (size * task_sequences)))
    arrival = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = pieces.repartition(tasks).sortWithinPartitions(arrival, "doc_id", "piece", "ids_crc32")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(size, open_bins)
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([first + n for n, _ in placed], pa.int64()), pa.array([at for _, at in placed], pa.int64())],
                names=[*batch.schema.names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def packed_documents(df: DataFrame, tokenizer: str, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, cut and pack whole documents; see ``tokenized_pieces`` and
    ``pack``. The pieces are written to the shared folder in between, so texts
    are encoded once and a lost executor repeats only the placing."""
    return pack(written(tokenized_pieces(df, tokenizer, size, id_col, text_col), "pieces"), size)
