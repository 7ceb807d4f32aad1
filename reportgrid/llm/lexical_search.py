"""Ranked search for words, best first, with range-maximum tables over posting lists.

The index is made in one pass over the documents: each task cuts its documents into shards of a bounded number of
postings and writes, for every term of a shard, which of its documents hold it how often. Whatever depends on the whole
corpus (number of documents, terms in all, documents that hold a term) is counted from the index.

The queries come in blocks of a bounded number of terms. For a block the posting lists of its terms are gathered by shard, and each
shard is searched alone:

* a posting's impact is its part of the score without the term's weight; a sparse table over the impacts of all lists gives the
  place of the largest one in any stretch of a list;
* an interval of documents is bounded by the sum, over the terms of the query, of the weighted largest impacts in it;
* the intervals with the largest bounds are split first, several at a time: at the document that holds the largest single
  term, which gets its exact score; what is left on both sides goes back with bounds of its own;
* an interval whose bound cannot get among the best that are known is dropped, so the answer is exact.

A task keeps its best from shard to shard. A hot term is spread over all shards, and no task holds more than a shard.

Defined results: a null text has no terms; documents without a term do not count; equal scores rank by ascending id, rows without an id
last; each of repeated rows is a document of its own, and so is each row of the queries; queries without known terms have no
rows. All columns but the ids and texts are ignored. The largest 64-bit number is not an id.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportgrid.sources.staging import staged

#: Postings after which a shard ends; a single longer document is one by itself.
SHARD = 1 << 19
#: Terms of the queries, repeats included, that are searched for together.
BLOCK_TERMS = 100_000
#: Intervals split in one step.
TOGETHER = 256
NO_ID = (1 << 63) - 1
#: Bytes of terms: digits, letters, everything beyond ASCII; A-Z become a-z, all others separate.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: What stands for a term in the two lists over the documents of a shard; no term is like them.
LENGTHS, IDS = b"", b" "
POSTINGS = "shard long, term binary, places array<int>, times array<long>"


def terms_of(data: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return data.translate(TERM_BYTES).split()


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The posting lists of each shard, and two lists over its documents: numbers of their terms, and ids."""
    first = TaskContext.get().partitionId() << 32
    number, size = 0, 0
    ids: list[int] = []
    lengths: list[int] = []
    known: dict[bytes, int] = {}
    numbers: list[np.ndarray] = []
    times: list[np.ndarray] = []

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal number, size
        # documents in the order of their ids, so that an interval of documents is one of ids
        order = np.argsort(np.array(ids, np.int64), kind="stable")
        place = np.empty(len(ids), np.int32)
        place[order] = np.arange(len(ids))
        term, count = np.concatenate(numbers), np.concatenate(times)
        at = np.repeat(place, [len(n) for n in numbers])
        by = np.lexsort((at, term))
        ends = np.cumsum(np.bincount(term, minlength=len(known))).astype(np.int32)
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        columns = [
            (list(known), pa.ListArray.from_arrays(offsets, pa.array(at[by])), pa.ListArray.from_arrays(offsets, pa.array(count[by]))),
        ]
        held = np.array(lengths, np.int64)[order]
        shown = pa.array(np.arange(len(ids), dtype=np.int32))
        one = pa.array([0, len(ids)], pa.int32())
        columns.append(([LENGTHS], pa.ListArray.from_arrays(one, shown), pa.ListArray.from_arrays(one, pa.array(held))))
        columns.append(([IDS], pa.ListArray.from_arrays(one, shown), pa.ListArray.from_arrays(one, pa.array(np.array(ids, np.int64)[order]))))
        for terms, places, counts in columns:
            shard = pa.array(np.full(len(terms), first + number))
            batch = pa.RecordBatch.from_arrays([shard, pa.array(terms, pa.binary()), places, counts], names=["shard", "term", "places", "times"])
            for low in range(0, len(batch), 10_000):
                yield batch.slice(low, 10_000)
        for held_list in (ids, lengths, numbers, times):
            held_list.clear()
        known.clear()
        number, size = number + 1, 0

    for batch in batches:
        for id_, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            terms = terms_of(text.as_py() or b"")
            if not terms:
                continue
            counts = Counter(terms)
            if size and size + len(counts) > SHARD:
                yield from flush()
            ids.append(NO_ID if id_ is None else id_)
            lengths.append(len(terms))
            numbers.append(np.array([known.setdefault(term, len(known)) for term in counts], np.int32))
            times.append(np.fromiter(counts.values(), np.int64, len(counts)))
            size += len(counts)
    if size:
        yield from flush()


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The posting lists of all documents, written to the shared folder: ``shard, term, places, times``."""
    text = F.col(text_col).cast("string").cast("binary")
    return staged(docs.select(F.col(id_col).cast("long"), text).mapInArrow(_shards, POSTINGS))


class Query:
    """The terms of a query, each once, with how often it stands there."""

    def __init__(self, item_id, terms: list[bytes]):
        self.item_id = item_id
        self.terms = Counter(terms)


class Lists:
    """The posting lists of a shard, one after the other, and the range-maximum table over them."""

    def __init__(self, ids: np.ndarray, lists: list[np.ndarray], impacts: list[np.ndarray]):
        self.ids = ids
        self.start = np.cumsum([0, *map(len, lists)])
        #: (list, document) of each posting as one number
        self.keys = np.concatenate([k * len(ids) + places for k, places in enumerate(lists)])
        self.impact = np.concatenate(impacts)
        #: level j: where the largest impact of the 2**j postings from here on is; one place more than there are postings
        levels = max(map(len, lists)).bit_length()
        self.tops = np.zeros((levels, len(self.keys) + 1), np.int32)
        self.tops[0, :-1] = np.arange(len(self.keys))
        for j in range(levels - 1):
            half = 1 << j
            low, high = self.tops[j, : -2 * half], self.tops[j, half:-half]
            self.tops[j + 1, : -2 * half] = np.where(self.impact[high] > self.impact[low], high, low)
        #: the greatest power of two up to a number
        self.level = np.frexp(np.arange(max(map(len, lists)) + 1))[1].astype(np.int8) - 1
        self.level[0] = 0

    def top(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Where the largest impacts of the stretches are; any place for empty ones."""
        level = self.level[high - low]
        left = self.tops[level, low]
        right = self.tops[level, np.maximum(high - (1 << level.astype(np.int64)), 0)]
        return np.where(self.impact[right] > self.impact[left], right, left)


class Best:
    """The best documents of a query up to now: (score, id) pairs, the worst of ``k`` as the mark to pass."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores > 0
        scores, ids = np.concatenate([self.scores, scores[good]]), np.concatenate([self.ids, ids[good]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]

    def open(self, bounds: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Whether documents of at most this score, from this id on, could get in."""
        if len(self.scores) < self.k:
            return bounds > 0
        last, id_ = self.scores[-1], self.ids[-1]
        return (bounds > last) | ((bounds == last) & (ids < id_))


def search_shard(lists: Lists, of: np.ndarray, weights: np.ndarray, best: Best) -> None:
    """Adds the best documents of a shard. ``of`` numbers the query's lists there, ``weights`` are theirs."""
    n = len(lists.ids)
    base = of * n

    def bounded(first, until, low, high):
        """The intervals that could hold one of the best, largest bound first."""
        top = lists.top(low, high)
        parts = np.where(high > low, lists.impact[top], 0) * weights
        bound = parts.sum(axis=1)
        keep = np.flatnonzero((until > first) & best.open(bound, lists.ids[np.minimum(first, n - 1)]))
        largest = parts[keep].argmax(axis=1)
        split = lists.keys[top[keep, largest]] - base[largest]
        return first[keep], until[keep], low[keep], high[keep], bound[keep], split

    whole = lists.start[of][None], lists.start[of + 1][None]
    waiting = bounded(np.zeros(1, np.int64), np.full(1, n), *whole)
    while len(waiting[0]):
        open_ = best.open(waiting[4], lists.ids[waiting[0]])
        first, until, low, high, bound, split = (x[open_] for x in waiting)
        if not len(first):
            break
        if len(first) > TOGETHER:
            order = np.argpartition(-bound, TOGETHER)
            now, later = order[:TOGETHER], order[TOGETHER:]
        else:
            now, later = np.arange(len(first)), np.arange(0)
        # the document at the split stands in each list at, or is missing from, this place
        key = base + split[now][:, None]
        at = np.searchsorted(lists.keys, key)
        there = np.minimum(at, len(lists.keys) - 1)
        held = lists.keys[there] == key
        impact = np.where(held, lists.impact[there], 0)
        best.add((impact * weights).sum(axis=1), lists.ids[split[now]])
        left = bounded(first[now], split[now], low[now], at)
        right = bounded(split[now] + 1, until[now], at + held, high[now])
        rest = tuple(x[later] for x in (first, until, low, high, bound, split))
        waiting = tuple(np.concatenate(x) for x in zip(rest, left, right))


def weight(n_docs: int, df: int) -> int:
    """What a term in ``df`` of all documents weighs, in thousandths."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _blocks(queries: DataFrame, id_col: str, text_col: str) -> Iterator[list[Query]]:
    """The queries in blocks; the driver holds one at a time."""
    text = F.col(text_col).cast("string")
    rows = queries.select(F.col(id_col).alias("item_id"), text.cast("binary").alias("text")).filter("text IS NOT NULL")
    rows = staged(rows.withColumn("deal", F.xxhash64("item_id", "text")))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // (8 * BLOCK_TERMS) + 1
    for block in range(n):
        part = rows.filter(F.pmod("deal", F.lit(n)) == block)
        yield [Query(r["item_id"], terms_of(bytes(r["text"]))) for r in part.collect()]


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents of every query: ``item_id, rank, doc_id, score``."""
    spark = docs.sparkSession
    lists = index(docs, id_col, text_col)
    lengths = lists.filter(F.col("term") == F.lit(LENGTHS))
    size = lengths.agg(
        F.coalesce(F.sum(F.size("times")), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.aggregate("times", F.lit(0).cast("long"), lambda a, b: a + b)), F.lit(0)).alias("terms"),
        F.count(F.lit(1)).alias("shards"),
    ).first()
    n_docs, n_terms, n_shards = size["n"], size["terms"], size["shards"]
    kind = queries.schema[item_col].dataType.simpleString()
    shape = f"asked long, item_id {kind}, doc_id long, score long"
    found = spark.createDataFrame([], shape)
    asked = 0
    for block in _blocks(queries, item_col, item_text_col):
        terms = sorted({term for query in block for term in query.terms})
        if not terms or not n_docs:
            asked += len(block)
            continue
        wanted = F.broadcast(spark.createDataFrame([(term,) for term in (LENGTHS, IDS, *terms)], "term binary"))
        mine = lists.join(wanted, "term").select("shard", "term", "places", "times")
        held = mine.filter(~F.col("term").isin(LENGTHS, IDS)).groupBy("term").agg(F.sum(F.size("places")).alias("df"))
        df = {bytes(r["term"]): r["df"] for r in held.collect()}  # one short record per term of the block
        sent = spark.sparkContext.broadcast((block, {term: weight(n_docs, n) for term, n in df.items()}, asked))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block, weights, first = sent.value
            best = [Best(k) for _ in block]
            for rows in _by_shard(batches):
                ids, n = rows.pop(IDS)[1], rows.pop(LENGTHS)[1]
                if not rows:
                    continue
                m = 75 + 25 * n * n_docs // n_terms
                number = {term: j for j, term in enumerate(rows)}
                impacts = [1_000_000_000 * tf // (1000 * tf + 12 * m[at]) for at, tf in rows.values()]
                shard = Lists(ids, [at for at, _ in rows.values()], impacts)
                for query, top in zip(block, best):
                    mine = [term for term in query.terms if term in number]
                    if mine:
                        of = np.array([number[term] for term in mine])
                        search_shard(shard, of, np.array([query.terms[term] * weights[term] for term in mine]), top)
            out = [(first + j, q.item_id, None if d == NO_ID else d, s) for j, (q, b) in enumerate(zip(block, best)) for d, s in zip(b.ids.tolist(), b.scores.tolist())]
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in out], schema=out_schema)

        names = ["asked", "item_id", "doc_id", "score"]
        out_schema = pa.schema([("asked", pa.int64()), ("item_id", _arrow(kind)), ("doc_id", pa.int64()), ("score", pa.int64())])
        tasks = min(n_shards, spark.sparkContext.defaultParallelism * 4)
        tasks = max(tasks, n_shards // 64)
        gathered = mine.repartition(tasks, "shard").sortWithinPartitions("shard", "term")
        found = found.unionByName(gathered.mapInArrow(run, shape))
        asked += len(block)
    order = Window.partitionBy("asked").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[bytes, tuple[np.ndarray, np.ndarray]]]:
    """The rows of one shard after the other: places and times of each term."""
    shard, rows = None, {}
    for batch in batches:
        for number, term, places, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
            if number != shard and rows:
                yield rows
                rows = {}
            shard = number
            rows[term] = places.values.to_numpy(), times.values.to_numpy()
    if rows:
        yield rows
