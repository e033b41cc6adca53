"""Best-fit packing of token pieces with a bounded number of open bins.

Each task keeps at most `open_bins` bins open.  One integer is the bitset of the
free space that open bins have; the smallest set bit at or above a piece's
length names the tightest bin.  When nothing fits and all are open, the fullest
closes.  What stays open at a task's end is packed again as units over fewer
tasks, round by round, until one task holds what is left: `open_bins` bins for
each of `FAN_IN` tasks, whatever the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evigrade.llm.tokens import word_tokenizer
from evigrade.session import cut

CAPACITY = 2048
OPEN_BINS = 256
#: Pieces for each task of the first round, at least, and tasks whose open bins one task of the next round takes.
TASK_PIECES = 250_000
FAN_IN = 16


class OpenBins:
    """Bounded-space online best fit over bins of equal capacity."""

    def __init__(self, capacity: int, slots: int):
        self.capacity, self.slots = capacity, slots
        self.mask, self.made, self.open = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        found = stack.pop()
        if not stack:
            self.mask &= ~(1 << free)
        self.open -= 1
        return found

    def _put(self, which: int, free: int) -> None:
        if free:
            self.by_free[free].append(which)
            self.mask |= 1 << free
            self.open += 1

    def place(self, length: int) -> tuple[int, int]:
        """The bin for a piece and its offset there."""
        fits = self.mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            which = self._take(free)
        else:
            if self.open == self.slots:
                self._take((self.mask & -self.mask).bit_length() - 1)
            which, free = self.made, self.capacity
            self.made += 1
        self._put(which, free - length)
        return which, self.capacity - free

    def rest(self) -> list[tuple[int, int]]:
        """Bins that are still open, with what they hold."""
        return [(which, self.capacity - free) for free, bins in enumerate(self.by_free) for which in bins]


def token_pieces(
    docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Every document's ids and the end id 0, cut into pieces of at most `capacity`.

    Rows: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokenizer(tokenizer)
        step = 4 * capacity
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                docs_of, pieces, starts, lengths, sums, ids = [], [], [], [], [], []
                texts = batch.column(1).slice(low, 512).to_pylist()
                for doc_id, text in zip(batch.column(0).slice(low, 512).to_pylist(), texts):
                    whole = encoder.encode(text or "") + b"\0\0\0\0"
                    for piece, at in enumerate(range(0, len(whole), step)):
                        part = whole[at : at + step]
                        docs_of.append(doc_id)
                        pieces.append(piece)
                        starts.append(at // 4)
                        lengths.append(len(part) // 4)
                        sums.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                columns = [
                    pa.array(docs_of, pa.int64()),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _pack_round(units: DataFrame, tasks: int, level: int, capacity: int, open_bins: int) -> DataFrame:
    """(unit, length) -> (unit, bin, offset, fill): the bin of each unit; unit null: an open bin and its fill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, open_bins)
        base = (level << 58) | (TaskContext.get().partitionId() << 34)
        names = ["unit", "bin", "offset", "fill"]
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(1).to_pylist()]
            which = pa.array([base + b for b, _ in placed], pa.int64())
            at = pa.array([o for _, o in placed], pa.int64())
            none = pa.nulls(len(placed), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), which, at, none], names=names)
        rest = bins.rest()
        none = pa.nulls(len(rest), pa.int64())
        which = pa.array([base + b for b, _ in rest], pa.int64())
        yield pa.RecordBatch.from_arrays([none, which, none, pa.array([n for _, n in rest], pa.int64())], names=names)

    dealt = units.select("unit", "length").repartition(tasks).sortWithinPartitions("unit")
    return cut(dealt.mapInArrow(run, "unit long, bin long, offset long, fill long"))


def best_fit(units: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """(unit long unique, length) -> (unit, bin, offset); no length above the capacity or below 1.

    An empty table gives an empty result.
    """
    n = units.count()
    tasks = max(1, -(-n // TASK_PIECES))
    level = 0
    packed = _pack_round(units, tasks, level, capacity, open_bins)
    placed = packed.where("unit is not null").select("unit", "bin", "offset")
    while tasks > 1:
        level, tasks = level + 1, -(-tasks // FAN_IN)
        left = packed.where("unit is null").select(F.col("bin").alias("unit"), F.col("fill").alias("length"))
        packed = _pack_round(left, tasks, level, capacity, open_bins)
        moved = packed.where("unit is not null").select(
            F.col("unit").alias("bin"), F.col("bin").alias("to"), F.col("offset").alias("shift")
        )
        placed = placed.join(moved, "bin", "left").select(
            "unit",
            F.coalesce("to", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        )
    return placed


def pack_documents(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    with_ids: bool = False,
) -> DataFrame:
    """Pack all documents into sequences of at most `capacity` tokens.

    docs: doc_id, text and any other columns, which are ignored.  One row per
    piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if
    asked for, ids.  A null text counts as empty and is the end id alone.  Only a
    document longer than a sequence is cut.  Repeated and null doc_ids are packed
    like any other row.  Places in a sequence are gapless from 0.  An empty table gives an empty result.
    """
    pieces = token_pieces(docs, tokenizer, capacity, with_ids)
    pieces = cut(pieces.withColumn("unit", F.monotonically_increasing_id()))
    return pieces.join(best_fit(pieces, capacity, open_bins), "unit").select(
        *[c for c in pieces.columns if c not in ("unit", "ids")],
        F.col("bin").alias("sequence_id"),
        "offset",
        *["ids"] * with_ids,
    )
