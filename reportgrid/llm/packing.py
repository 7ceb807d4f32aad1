"""Packing tokenized documents into sequences of a fixed length, by sums of squares.

Each document is encoded whole and closed by an end token. One longer than a sequence is cut into full pieces behind
a first piece that takes the rest. A full piece is a sequence by itself. All others are dealt evenly, by a hash, to groups of
about ``GROUP`` pieces, one task each. A group is packed from its longest piece to its shortest:

* how many open sequences have which gap is kept as one count per gap;
* a piece goes to the open sequence for which the sum of the squares of these counts gets smallest, of several to that
  with the smallest gap; only if it fits in none, a sequence is begun.

So no gap gets frequent for which fitting pieces are rare. The loss against the least thinkable number of sequences
does not grow with the number of groups: each holds enough pieces of all lengths to fill its gaps. Nothing but numbers per
piece is shuffled, and what a task keeps is bounded by the size of a group, whatever the pieces are.

Defined results: a null or empty text is the end token alone; each of repeated rows, and each row without an id, is a
document; a length of exactly a multiple of the sequence has no shorter piece; no rows give no rows. All columns but the id and the text
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportgrid.llm.word_encoding import byte_level
from reportgrid.sources.staging import staged

#: Pieces in a group.
GROUP = 1 << 16
PIECE = "piece int, start long, length long, ids_crc32 long"
NEVER = 1 << 60


def spans(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


class Sequences:
    """The open sequences of a group: how many have which gap, and which they are."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """The sequence that a piece goes to, and its place there."""
        count = self.count
        gaps = count[length : self.capacity]
        # what the sum of squares changes by: a sequence leaves one gap and comes to another; a filled one has none
        change = np.where(gaps > 0, 2 * (count[: len(gaps)] - gaps) + 2, NEVER)
        if len(gaps) and gaps[0]:
            change[0] -= 1
        left = int(change.argmin()) if len(gaps) else 0
        if not len(gaps) or change[left] == NEVER:
            number, gap, left = self.made, self.capacity, self.capacity - length
            self.made += 1
        else:
            gap = length + left
            number = self.open[gap].pop()
            count[gap] -= 1
        if left:
            count[left] += 1
            self.open[left].append(number)
        return number, self.capacity - gap


def place_all(lengths: Iterable[int], capacity: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each piece, in the order given."""
    group = Sequences(capacity)
    return [group.place(n) for n in lengths]


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece of each document: ``doc_id``, ``piece, start, length, ids_crc32``, and a number ``lot`` of its own."""
    if capacity < 1:
        raise ValueError("a sequence holds at least one token")
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "lot"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = byte_level(sent.value)
        lot = TaskContext.get().partitionId() << 40
        end = np.array([end_id], np.uint32)
        for batch in batches:
            of: list[int] = []
            out: list[tuple[int, int, int, int, int]] = []
            for k, text in enumerate(batch.column(1)):
                ids = np.concatenate([by.encode(text.as_py()), end]).astype("<u4")
                for piece, (start, length) in enumerate(spans(len(ids), capacity)):
                    of.append(k)
                    out.append((piece, start, length, zlib.crc32(ids[start : start + length]), lot))
                    lot += 1
            types = [pa.int32(), *[pa.int64()] * 4]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int64())), *columns], names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, {PIECE}, lot long")


def pack(
    docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row for each piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    found = staged(pieces(docs, vocabulary, end_id, capacity, id_col, text_col))
    shape = f"doc_id {found.schema['doc_id'].dataType.simpleString()}, {PIECE}, sequence_id long, offset long"
    alone = F.col("length") == capacity
    full = found.filter(alone).withColumns({"sequence_id": -1 - F.col("lot"), "offset": F.lit(0).cast("long")}).drop("lot")
    open_ = found.filter(~alone)
    groups = open_.count() // GROUP + 1

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        group = pa.Table.from_batches(held).combine_chunks()
        # longest first; equal lengths in the order of their numbers, so that a task that runs again gives the same
        group = group.sort_by([("length", "descending"), ("lot", "ascending")])
        number, offset = zip(*place_all(group.column("length").to_numpy().tolist(), capacity))
        first = TaskContext.get().partitionId() << 32
        done = group.drop_columns(["lot"])
        done = done.append_column("sequence_id", pa.array(np.array(number, np.int64) + first))
        yield from done.append_column("offset", pa.array(offset, pa.int64())).to_batches(max_chunksize=10_000)

    dealt = open_.repartition(groups, F.xxhash64("lot"))
    return full.unionByName(dealt.mapInArrow(fill, shape))
