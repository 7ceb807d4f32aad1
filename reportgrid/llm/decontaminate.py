"""Finds benchmark items inside documents, also with words changed, lost or added.

Item and document are sequences of words, lower-cased. A document holds an item if some stretch of it is within
``MAX_EDITS`` of the item's words in edit distance. Candidates come from the CGK embedding: a random walk over a window copies the
word it stands on at each step and moves on or stays by a random bit of (step, word), which turns few edits
into few different symbols. Bit sampling hashes ``SAMPLED`` of the ``STEPS`` symbols, for ``REPEATS`` walks of their own.
Windows start at every word of a document and at every word of an item, so the windows of an item
together are as long as the item, and one stretch without many edits is enough. Each candidate is
then checked by the exact edit distance (bit-parallel, over the words).

Items with too few such windows, as they are short or hold few different words, are searched exactly: cut into one piece
more than the edits allowed, at least one piece stands unchanged in each place of the item; pieces meet the documents by hash.

The expected recall for an edit at each word with probability MAX_EDITS / 2 is above 0.99, at MAX_EDITS above 0.9 (tests/llm measures it).

The benchmark is the stated set of questions: it is taken in blocks of about ``BLOCK_WORDS`` words, chosen by hash, each sent to
all tasks; documents are read once per block and never shuffled. All documents are searched whole.

Defined results: null and blank texts hold nothing; items without a word are in no document, an item of one word is in all that have it;
a document with several places of an item has one row with the fewest edits, the first such place; repeated
rows of documents get the same rows each, repeated items are one; rows without an id are searched and have a null id.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_EDITS = 0.2
STEPS, SAMPLED, REPEATS = 12, 5, 5
#: Different words that a window of an item must have among its samples.
LEAST_DISTINCT = 4
#: Share of an item's words that must begin a window with a key; below, the item is searched by its pieces.
LEAST_KEYED = 0.5
BLOCK_WORDS = 200_000
#: Words of documents that are embedded at once.
CHUNK_WORDS = 1 << 16
#: Characters hashed at once, and the base of a word's hash.
SLICE, BASE = 1 << 17, 0xD1342543DE82EF95
FILTER_BITS = 22
WORD = re.compile(r"\w+")
MIX = np.uint64(0x9E3779B97F4A7C15)


@cache
def _word_characters() -> np.ndarray:
    """Which code points are word characters, as ``WORD`` has them."""
    return np.fromiter((c.isalnum() or c == "_" for c in map(chr, range(sys.maxunicode + 1))), bool, sys.maxunicode + 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


@cache
def _slice_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(BASE, size + 1), _powers(pow(BASE, -1, 1 << 64), size + 1)


def _slices(text: str) -> Iterator[str]:
    """The text in slices of about ``SLICE`` characters that cut no word."""
    is_word, low = _word_characters(), 0
    while low < len(text):
        high = low + SLICE
        if high < len(text):
            while high > low and is_word[ord(text[high - 1])]:
                high -= 1
            if high == low:  # one word is longer than a slice
                high += SLICE
                while high < len(text) and is_word[ord(text[high])]:
                    high += 1
        yield text[low:high]
        low = high


def word_hashes(text: str | None) -> array:
    """The hashes of all words of a text, lower-cased: sums of its characters' numbers times powers of an odd base, modulo 2**64,
    as differences of running sums."""
    out = array("Q")
    for part in _slices((text or "").lower()):
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        edges = np.flatnonzero(np.diff(_word_characters()[points], prepend=False, append=False))
        begin, end = edges[::2], edges[1::2]
        up, down = _slice_powers(SLICE)
        if len(points) > SLICE:
            up, down = _powers(BASE, len(points)), _powers(pow(BASE, -1, 1 << 64), len(points))
        sums = np.zeros(len(points) + 1, np.uint64)
        numbers = (points.astype(np.uint64) + np.uint64(1)) * MIX
        numbers ^= numbers >> np.uint64(29)
        numbers *= up[: len(points)]
        np.cumsum(numbers, out=sums[1:])
        found = (sums[end] - sums[begin]) * down[begin]
        found ^= found >> np.uint64(32)
        found *= MIX
        found ^= found >> np.uint64(29)
        out.frombytes((found | np.uint64(1)).tobytes())
    return out


def _walks() -> list[tuple[np.uint64, list[int]]]:
    """Per repetition, the multiplier of its random bits and the steps it samples; fixed by a seed."""
    rng = np.random.default_rng(20240229)
    return [
        (np.uint64(int(rng.integers(1, 2**63)) * 2 + 1), sorted(rng.choice(STEPS, SAMPLED, replace=False).tolist()))
        for _ in range(REPEATS)
    ]


def keys(hashes: np.ndarray, seen: list | None = None) -> Iterator[np.ndarray]:
    """Per repetition, the key of the window at each place. ``seen`` gets the places sampled, a row per sample.

    ``hashes`` must end with ``STEPS`` places of padding; no keys are made for those.
    """
    n = len(hashes) - STEPS
    for odd, sampled in _walks():
        bits = hashes * odd
        bits ^= bits >> np.uint64(29)
        bits *= MIX
        moves = (bits >> np.uint64(40)).astype(np.uint32)
        at = np.arange(n, dtype=np.int32)
        key = np.zeros(n, np.uint64)
        for step in range(STEPS):
            if step in sampled:
                key *= MIX
                key += hashes[at]
                if seen is not None:
                    seen.append(at.copy())
            at += ((moves[at] >> np.uint32(step)) & np.uint32(1)).astype(np.int32)
        key ^= key >> np.uint64(31)
        yield key


def pieces(n: int) -> list[tuple[int, int]]:
    """Where the pieces of an item of ``n`` words begin and end: one more than the edits allowed, all of them two words at least but for ``n`` = 1."""
    parts = int(MAX_EDITS * n) + 1
    cuts = [n * k // parts for k in range(parts + 1)]
    return list(zip(cuts, cuts[1:]))


def runs(hashes: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per length up to ``longest``, a key of so many words in a row at each place."""
    key = np.zeros(len(hashes), np.uint64)
    for n in range(1, longest + 1):
        key = key[: len(hashes) - n + 1] * MIX + hashes[n - 1 :]
        yield n, key ^ (key >> np.uint64(31))


def edits(item: Sequence[int], text: Sequence[int]) -> tuple[int, int]:
    """The least edit distance between the item and any stretch of the text, and where the first such stretch ends."""
    n = len(item)
    masks: dict = defaultdict(int)
    for k, w in enumerate(item):
        masks[w] |= 1 << k
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best, end = n, 0
    for k, w in enumerate(text):
        eq = masks.get(w, 0)
        d0 = ((((eq & plus) + plus) ^ plus) | eq | minus) & full
        hp = (minus | ~(d0 | plus)) & full
        hn = plus & d0
        score += bool(hp & top) - bool(hn & top)
        hp <<= 1  # a stretch may begin anywhere: nothing is paid above the first row
        plus = ((hn << 1) | ~(d0 | hp)) & full
        minus = hp & d0 & full
        if score < best:
            best, end = score, k + 1
    return best, end


class Items:
    """A block of items and the keys of their windows."""

    def __init__(self, rows: list[tuple[int, array]]):
        self.rows = rows
        found: list[dict[int, list[tuple[int, int]]]] = [defaultdict(list) for _ in range(REPEATS)]
        self.pieces: dict[int, dict[int, list[tuple[int, int]]]] = {}
        self.words = [Counter(item) for _, item in rows]
        for number, (_, item) in enumerate(rows):
            padded = np.array([*item, *[0] * STEPS], np.uint64)
            seen: list[np.ndarray] = []
            keyed = 0
            for k, key in enumerate(keys(padded, seen)):
                sampled = padded[np.array(seen)]
                seen.clear()
                for place in range(len(item)):
                    # a window that samples one word again and again would match any text that repeats it
                    inside = set(sampled[:, place].tolist()) - {0}
                    if sampled[:, place].all() and len(inside) >= LEAST_DISTINCT:
                        found[k][int(key[place])].append((number, place))
                        keyed += 1
            if keyed < LEAST_KEYED * REPEATS * len(item):
                self._add_pieces(number, padded[: len(item)])
        self.found = found
        self.sorted = [np.array(sorted(f), np.uint64) for f in found]
        mask = np.uint64((1 << FILTER_BITS) - 1)

        def as_filter(each: np.ndarray) -> np.ndarray:
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[each & mask] = True
            return bits

        self.filters = [as_filter(each) for each in self.sorted]
        self.sorted_pieces = {n: np.array(sorted(f), np.uint64) for n, f in self.pieces.items()}
        self.piece_filters = {n: as_filter(each) for n, each in self.sorted_pieces.items()}

    def _add_pieces(self, number: int, item: np.ndarray) -> None:
        for begin, end in pieces(len(item)):
            *_, (n, key) = runs(item[begin:end], end - begin)
            self.pieces.setdefault(n, defaultdict(list))[int(key[0])].append((number, begin))

    def search(self, docs: list[array]) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, edits, end) for each item that a document holds; documents as word hashes."""
        starts = np.cumsum([0, *[len(d) + STEPS for d in docs]])
        padded = np.zeros(int(starts[-1]) + STEPS, np.uint64)
        for start, doc in zip(starts.tolist(), docs):
            padded[start : start + len(doc)] = doc
        mask = np.uint64((1 << FILTER_BITS) - 1)
        places: set[tuple[int, int, int]] = set()
        for k, key in enumerate(keys(padded)):
            hits = np.flatnonzero(self.filters[k][key & mask])
            hits = hits[np.isin(key[hits], self.sorted[k])]
            of = np.searchsorted(starts, hits, "right") - 1
            for at, doc in zip(hits.tolist(), of.tolist()):
                for number, place in self.found[k][int(key[at])]:
                    slack = int(MAX_EDITS * len(self.rows[number][1])) + 1
                    places.add((doc, number, (at - int(starts[doc]) - place) // slack))
        for n, key in runs(padded, max(self.pieces, default=0)):
            if n not in self.pieces:
                continue
            hits = np.flatnonzero(self.piece_filters[n][key & mask])
            hits = hits[np.isin(key[hits], self.sorted_pieces[n])]
            of = np.searchsorted(starts, hits, "right") - 1
            for at, doc in zip(hits.tolist(), of.tolist()):
                for number, place in self.pieces[n][int(key[at])]:
                    slack = int(MAX_EDITS * len(self.rows[number][1])) + 1
                    places.add((doc, number, (at - int(starts[doc]) - place) // slack))
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for doc, number, diagonal in sorted(places):
            if best.get((doc, number), (1, 0))[0] == 0:
                continue  # an unchanged place further on ends later
            item = self.rows[number][1]
            most = int(MAX_EDITS * len(item))
            first = max(0, diagonal * (most + 1) - most)
            stretch = docs[doc][first : (diagonal + 1) * (most + 1) + len(item) + most]
            # each word of the item that the stretch lacks costs an edit
            lacks = self.words[number].keys() - set(stretch)
            if sum(self.words[number][w] for w in lacks) > most:
                continue
            n, end = edits(item, stretch)
            if n <= most and (n, first + end) < best.get((doc, number), (most + 1, 0)):
                best[doc, number] = n, first + end
        for (doc, number), (n, end) in best.items():
            yield doc, number, n, end


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in blocks of about ``BLOCK_WORDS`` words; the driver holds one block at a time."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    size = rows.agg(F.coalesce(F.sum(F.size(F.split("text", r"\W+"))), F.lit(0))).first()[0]
    n = size // BLOCK_WORDS + 1
    for block in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == block)
        yield [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()]


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """A row for each document and item it holds: ``doc_id, item_id, edits, item_words, end_word``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, item_id long, edits int, item_words int, end_word int"
    names = ["doc_id", "item_id", "edits", "item_words", "end_word"]
    found = []
    for block in _blocks(benchmark, item_col, item_text_col):
        items = [(i, h) for i, t in block if len(h := word_hashes(t))]
        if not items:
            continue
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            asked = Items(sent.value)

            def flush(ids: list, parts: list[array], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
                out = [(ids[d], asked.rows[i][0], n, len(asked.rows[i][1]), end) for d, i, n, end in asked.search(parts)]
                if out:
                    types = [id_type, pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

            for batch in batches:
                ids, parts, size = [], [], 0
                for id_, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids.append(id_)
                    parts.append(word_hashes(text.as_py()))
                    size += len(parts[-1])
                    if size >= CHUNK_WORDS:
                        yield from flush(ids, parts, batch.schema.field(0).type)
                        ids, parts, size = [], [], 0
                if parts:
                    yield from flush(ids, parts, batch.schema.field(0).type)

        found.append(rows.mapInArrow(run, shape))
    if not found:
        return docs.sparkSession.createDataFrame([], shape)
    return reduce(DataFrame.unionByName, found)
