"""Removes repeated passages: every byte covered by a string of ``LENGTH`` bytes that also starts earlier.

Sorting the suffixes at every byte would multiply the input, so only suffixes at anchors are sorted. An anchor is a
place where the hash of the next ``GRAM`` bytes is the least among all such places of some string of ``LENGTH`` bytes; each such string
holds an anchor that depends on its bytes alone, so equal strings have theirs at the same place. Anchors whose
gram occurs once cannot be part of a repetition and are dropped by a first pass over the hashes. The suffixes at the others, with the bytes
before them that a string may begin with, are range-partitioned by their leading bytes with splitters from a sample, and sorted within their
bucket by multikey sort: word by word, only what is still tied. The lengths of common prefixes of neighbours, to
the right and to the left of the anchor, say which strings of ``LENGTH`` bytes around it are equal; all but the earliest
of these (smaller id, then smaller start) are removed. Suffixes with equal leading bytes are in one bucket, so no comparison has to cross a boundary.

Leading bytes that stand in very many different surroundings (a common phrase) would be one large group. The first pass
counts the surroundings of each anchor; where they are more than a part of a task's share, the strings of ``LENGTH`` bytes around the anchor
are sent one by one, by a digest of all their bytes, which parts the group over all tasks: equal strings meet, and nothing else does.
There are at most ``HOT_PARTS`` such anchors per task, so the list of them is bounded.

Equal texts are worked on once: the copies of a text with larger ids are removed whole. Suffixes that are equal as far as can matter are
reduced to the earliest of a task before they are shuffled, so a passage in a third of all documents
sends one row per task to its bucket.

Defined results: null is the empty text; texts shorter than ``LENGTH`` bytes are kept whole; matches never cross documents; a row without id counts
as smaller than all others; the same id and start is not earlier, so repeated rows get the same answer each; strings are
judged on the input, not on what is left; all other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportgrid.sources.staging import staged

LENGTH = 100
#: Bytes hashed at a place.
GRAM = 24
#: Bytes that a string with its anchor's gram can have besides it.
REST = LENGTH - GRAM
#: Bits of a long that say the place in a text; the others are of the text's digest.
PLACE_BITS = 28
#: Rows of texts sampled for the splitters (expected), anchors taken of each, and suffixes sorted at once.
SAMPLE_TEXTS, SAMPLE_ANCHORS, AT_ONCE = 2000, 64, 40_000
#: Surroundings of one gram from which on it can be hot, and the part of a task's share that makes it so.
HOT_LEAST, HOT_PARTS = 256, 4
#: Different suffixes that a task holds before it sends them on.
HELD = 50_000
#: Different strings around hot anchors that a task holds.
HELD_STRINGS = 200_000
MIX = np.uint64(0x9E3779B97F4A7C15)
NO_ID = -(1 << 63)


def _doubled(a: np.ndarray, size: int, join) -> np.ndarray:
    """``join`` over every stretch of ``size`` neighbours, by doubling; ``join`` may take an element twice."""
    have = 1
    while have * 2 <= size:
        a = join(a[:-have], a[have:])
        have *= 2
    return a if have == size else join(a[: len(a) - (size - have)], a[size - have :])


def gram_hashes(data: bytes) -> np.ndarray:
    """A hash of the ``GRAM`` bytes at every place that has so many."""
    a = np.frombuffer(data, np.uint8).astype(np.uint64)
    a += np.uint64(1)
    a *= MIX
    size = 1
    for step, odd in ((1, 0xBF58476D1CE4E5B9), (2, 0x94D049BB133111EB), (4, 0xD6E8FEB86659FD93)):
        a = (a[:-step] * np.uint64(odd)) + (a[step:] ^ (a[step:] >> np.uint64(29)))
        size += step
    # eight bytes so far; three of these make a gram
    a ^= a >> np.uint64(32)
    a = (a[:-16] * np.uint64(0xBF58476D1CE4E5B9) + a[8:-8]) * np.uint64(0x94D049BB133111EB) + a[16:]
    a ^= a >> np.uint64(31)
    a *= MIX
    a ^= a >> np.uint64(29)
    return a


def anchors(data: bytes, h: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of a text and their hashes; ``h`` are its gram hashes, if known."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if h is None:
        h = gram_hashes(data)
    least = _doubled(h, REST + 1, np.minimum)  # of each string, by its start
    # a place is an anchor if it is the least of some string that holds it
    most = _doubled(np.concatenate([np.zeros(REST, np.uint64), least, np.zeros(REST, np.uint64)]), REST + 1, np.maximum)
    at = np.flatnonzero(h == most[: len(h)])
    return at, h[at]


def surroundings(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number for the bytes on both sides of each place, from the gram hashes ``h`` of the text."""
    out = np.zeros(len(at), np.uint64)
    for step in (-3 * GRAM, -2 * GRAM, -GRAM, GRAM, 2 * GRAM, 3 * GRAM):
        out *= MIX
        out += h[np.clip(at + step, 0, len(h) - 1)]
    return out ^ (out >> np.uint64(31))


def text_number(key: bytes) -> int:
    """The bits of a text's digest that stand beside a place."""
    return int.from_bytes(key[:8], "big") >> PLACE_BITS


def _rows(columns: list, types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, at, known, weight) of all anchors of texts new in this batch.

    Of a hash that the batch has more than once, one row goes to where all of its hash meet, with the number of its different surroundings
    in the batch as weight; the others are known to be repeated and are spread by their own place.
    """
    for batch in batches:
        seen: set[bytes] = set()
        hashes, places, around = [], [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if key in seen:
                continue
            seen.add(key)
            data = text.as_py().encode("utf-8")
            if len(data) < LENGTH:
                continue
            every = gram_hashes(data)
            at, h = anchors(data, every)
            hashes.append(h)
            around.append(surroundings(every, at))
            places.append((np.uint64(text_number(key)) << np.uint64(PLACE_BITS)) + at.astype(np.uint64))
        if not hashes or not sum(map(len, hashes)):
            continue
        h, at, sides = np.concatenate(hashes), np.concatenate(places), np.concatenate(around)
        _, first, of, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        known = np.flatnonzero(count[of] > 1)
        weight = np.ones(len(first), np.int32)
        if len(known):
            by = known[np.lexsort((sides[known], of[known]))]
            another = (of[by][1:] == of[by][:-1]) & (sides[by][1:] != sides[by][:-1])
            weight += np.bincount(of[by][1:][another], minlength=len(first)).astype(np.int32)
        slots = np.concatenate([h[first], at[known] * MIX])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(slots.view(np.int64)),
                pa.array(np.concatenate([at[first], at[known]]).view(np.int64)),
                pa.array(np.concatenate([np.zeros(len(first), bool), np.ones(len(known), bool)])),
                pa.array(np.concatenate([weight, np.zeros(len(known), np.int32)])),
            ],
            names=["slot", "at", "known", "weight"],
        )


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by slot, the places that are known to be repeated or share their slot with another place, with their weight.

    A slot of ``HOT_LEAST`` or more surroundings gives a row of its own, without a place.
    """
    last_slot = last_at = None
    last_weight, total = 0, 0
    told = False
    names, types = ["at", "weight", "slot"], [pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        slots, at, known, weight = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        if not len(slots):
            continue
        same = slots[1:] == slots[:-1]
        shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        out, weights = at[shared | known], weight[shared | known]
        goes_on = last_slot is not None and slots[0] == last_slot
        if goes_on:
            more = [(at[0], weight[0])] if not shared[0] | known[0] else []
            more += [] if told else [(last_at, last_weight)]
            out = np.append(out, np.array([m[0] for m in more], np.int64))
            weights = np.append(weights, np.array([m[1] for m in more], np.int64))
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        sums = np.add.reduceat(weight.astype(np.int64), starts)
        run_slots = slots[starts]
        if goes_on:
            sums[0] += total
        elif total >= HOT_LEAST:
            run_slots, sums = np.append(last_slot, run_slots), np.append(total, sums)
        hot = np.flatnonzero(sums[:-1] >= HOT_LEAST)  # the last run may go on
        yield _rows(
            [np.append(out, np.zeros(len(hot), np.int64)).tolist(), [*weights.tolist(), *sums[hot].tolist()], [None] * len(out) + run_slots[hot].tolist()],
            types,
            names,
        )
        last_slot, last_at, last_weight, total = slots[-1], at[-1], weight[-1], int(sums[-1])
        told = bool(shared[-1] | known[-1] | (len(slots) == 1 and goes_on))
    if total >= HOT_LEAST:
        yield _rows([[0], [total], [int(last_slot)]], types, names)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts, each once a task, compressed."""
    seen: set[bytes] = set()
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        rows = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if key not in seen:
                seen.add(key)
                rows.append((text_number(key), key, squeeze.compress(text.as_py().encode("utf-8"))))
        columns = list(zip(*rows)) or [[]] * 3
        yield _rows(columns, [pa.int64(), pa.binary(), pa.binary()], ["number", "key", "packed"])


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, with those that touch made one."""
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


SUFFIX = ["bucket", "lead", "before", "after", "number", "doc", "place", "low", "high"]
SUFFIX_TYPES = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
SUFFIX_DDL = (
    "bucket int, lead binary, before binary, after binary, number long, doc long, place long, low long, high long"
)


def _suffixes(splitters: np.ndarray, hot: np.ndarray):
    """Rows of suffixes, of strings around ``hot`` grams (``lead`` is their digest, ``after`` is null), and of spans that need
    no comparison beyond the task (``lead`` is null). ``hot`` are sorted gram hashes."""
    buckets = len(splitters) + 1

    def bucket_of(lead: bytes) -> int:
        return int(np.searchsorted(splitters, int.from_bytes(lead[:8], "big"), "right"))

    def flush(held: dict, strings: dict, spans: dict) -> Iterator[pa.RecordBatch]:
        rows = [
            (bucket_of(lead), lead, before, after, number, doc, place, None, None)
            for (lead, before, after), (doc, place, number) in held.items()
        ]
        for digest, (doc, start, number) in strings.items():
            rows.append((int.from_bytes(digest[:6], "big") % buckets, digest, None, None, number, doc, start, None, None))
            if len(rows) >= 10_000:
                yield _rows(list(zip(*rows)), SUFFIX_TYPES, SUFFIX)
                rows = []
        for (number, doc), found in spans.items():
            for low, high in _joined(found):
                rows.append((number % buckets, None, None, None, number, doc, None, low, high))
        held.clear()
        strings.clear()
        spans.clear()
        for k in range(0, len(rows), 10_000):
            yield _rows(list(zip(*rows[k : k + 10_000])), SUFFIX_TYPES, SUFFIX)

    def is_hot(data: bytes, places: np.ndarray) -> np.ndarray:
        if not len(hot) or not len(places):
            return np.zeros(len(places), bool)
        grams = np.frombuffer(data, np.uint8)[(places[:, None] + np.arange(GRAM)).ravel()]
        return np.isin(gram_hashes(grams.tobytes())[::GRAM], hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bytes, bytes, bytes], tuple[int, int, int]] = {}
        strings: dict[bytes, tuple[int, int, int]] = {}
        spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
        done: set[bytes] = set()
        open_ = zstandard.ZstdDecompressor()

        def add_span(number: int, doc: int, low: int, high: int) -> None:
            found = spans.setdefault((number, doc), [])
            if found and found[-1][0] <= low <= found[-1][1]:
                found[-1] = (found[-1][0], max(high, found[-1][1]))
            else:
                found.append((low, high))

        for batch in batches:
            for number, key, packed, labels, places in zip(*[batch.column(k) for k in range(5)]):
                key = key.as_py()
                if key in done:
                    continue
                if len(done) > HELD:
                    done.clear()
                done.add(key)
                number, data = number.as_py(), open_.decompress(packed.as_py())
                doc = next(x["first_id"] for x in labels.as_py() if x["key"] == key)
                n = len(data)
                known = np.unique(places.values.to_numpy(zero_copy_only=False)) if places.as_py() else np.zeros(0, np.int64)
                if n >> PLACE_BITS:
                    known = np.union1d(known, (at := anchors(data)[0])[at >> PLACE_BITS > 0])
                known = known[known <= n - GRAM]
                split = is_hot(data, known)
                past = 0  # a string with several hot anchors is sent once
                for place in known[split].tolist():
                    for start in range(max(past, place - REST), min(place, n - LENGTH) + 1):
                        digest = xxhash.xxh3_128_digest(data[start : start + LENGTH])
                        first, mine = strings.get(digest), (doc, start, number)
                        if first is None or mine[:2] < first[:2]:
                            strings[digest] = mine
                        if first is not None and first[:2] != mine[:2]:
                            doc_, start_, number_ = max(first, mine)
                            add_span(number_, doc_, start_, start_ + LENGTH)
                        if len(strings) > HELD_STRINGS:
                            yield from flush(held, strings, spans)
                    past = max(past, place + 1)
                for place in known[~split].tolist():
                    begin = max(0, place - REST)
                    suffix = data[place : place + LENGTH]
                    what = (suffix[:GRAM], data[begin:place], suffix[GRAM:])
                    mine = (doc, place, number)
                    first = held.get(what)
                    if first is None or mine[:2] < first[:2]:
                        held[what] = mine
                    if first is None or first[:2] == mine[:2]:
                        continue
                    # one of the two starts earlier with the same bytes all around: every string of the other is repeated
                    doc_, place_, number_ = max(first, mine)
                    low = place_ - len(what[1])
                    high = place_ + GRAM + len(what[2])
                    if high - low >= LENGTH:
                        add_span(number_, doc_, low, high)
                if len(held) > HELD or len(spans) > HELD:
                    yield from flush(held, strings, spans)
        yield from flush(held, strings, spans)

    return run


def multikey_sort(groups: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of strings of equal width within their groups, and each string's common prefix with the one before.

    Strings are rows of bytes, padded to whole words. Each word is looked at only where all before it are tied.
    A string that begins a group has a common prefix of -1.
    """
    n, width = strings.shape
    words = np.ascontiguousarray(strings).view(">u8").astype(np.uint64)
    order = np.lexsort((words[:, 0], groups))

    def tied(k: int) -> np.ndarray:
        """Whether the row at a place of the order equals the one before, up to and with word ``k``."""
        a = order[1:], order[:-1]
        same = (groups[a[0]] == groups[a[1]]) & (words[a[0], 0] == words[a[1], 0])
        for j in range(1, k + 1):
            at = np.flatnonzero(same)
            if not len(at):
                break
            same[at] = words[order[at + 1], j] == words[order[at], j]
        return same

    for k in range(1, words.shape[1]):
        same = tied(k - 1)
        rows = np.flatnonzero(np.concatenate([[False], same]) | np.concatenate([same, [False]]))
        if not len(rows):
            break
        run = np.cumsum(~np.concatenate([[False], same]))[rows]
        order[rows] = order[rows][np.lexsort((words[order[rows], k], run))]
    common = np.full(n, -1)
    together = np.flatnonzero(groups[order[1:]] == groups[order[:-1]])
    for k in range(0, len(together), 1 << 16):
        at = together[k : k + (1 << 16)]
        differ = strings[order[at + 1]] != strings[order[at]]
        common[at + 1] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, common


def _matrix(parts: list[bytes], reverse: bool) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as rows of equal width, and their lengths."""
    width = -(-REST // 8) * 8
    lengths = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    flat = b"".join(((p[::-1] if reverse else p).ljust(width, b"\0")) for p in parts)
    return np.frombuffer(flat, np.uint8).reshape(len(parts), width), lengths


def repeated_spans(
    leads: list[bytes], before: list[bytes], after: list[bytes], docs: np.ndarray, places: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of suffixes with what stands before them: which have a repeated string, and the stretch that these cover."""
    number: dict[bytes, int] = {}
    groups = np.fromiter((number.setdefault(x, len(number)) for x in leads), np.int64, len(leads))
    # in the order of their occurrence, without groups of one
    order = np.lexsort((places, docs))
    order = order[np.bincount(groups)[groups[order]] > 1]
    if not len(order):
        return order, order, order
    groups, docs, places = groups[order], docs[order], places[order]
    right, n_right = _matrix([after[k] for k in order.tolist()], False)
    left, n_left = _matrix([before[k] for k in order.tolist()], True)
    right_order, right_common = multikey_sort(groups, right)
    left_order, left_common = multikey_sort(groups, left)
    n = len(order)
    most, least = np.full(n, -1), np.full(n, REST + 1)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for i in range(REST + 1):  # bytes of the string before the anchor
        valid = np.flatnonzero((n_left >= i) & (n_right >= REST - i))
        if len(valid) < 2:
            continue
        right_class[right_order] = np.cumsum(right_common < REST - i)
        left_class[left_order] = np.cumsum(left_common < i)
        both = right_class[valid] * (n + 1) + left_class[valid]
        by = np.argsort(both, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], both[by][1:] != both[by][:-1]]))
        first = valid[by[np.repeat(starts, np.diff(np.append(starts, len(by))))]]
        mine = valid[by]
        later = mine[(docs[mine] != docs[first]) | (places[mine] != places[first])]
        most[later] = np.maximum(most[later], i)
        least[later] = np.minimum(least[later], i)
    found = np.flatnonzero(most >= 0)
    return order[found], places[found] - most[found], places[found] - least[found] + LENGTH


class _Strings:
    """Of strings sorted by digest, document and start, those whose like came before; one row is kept between batches."""

    def __init__(self):
        self.digest: bytes | None = None
        self.first = (0, 0)

    def later(self, rows: pa.Table) -> pa.Table:
        lead = rows.column("lead").combine_chunks()
        docs, places = rows.column("doc").to_numpy(), rows.column("place").to_numpy()
        same = pa.compute.equal(lead[1:], lead[:-1]).to_numpy(zero_copy_only=False)
        begins = np.concatenate([[lead[0].as_py() != self.digest], ~same])
        at = np.maximum.accumulate(np.where(begins, np.arange(len(docs)), -1))
        first_doc = np.where(at < 0, self.first[0], docs[at])
        first_place = np.where(at < 0, self.first[1], places[at])
        self.digest, self.first = lead[-1].as_py(), (int(first_doc[-1]), int(first_place[-1]))
        return rows.filter(pa.array((docs != first_doc) | (places != first_place)))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(number, doc, low, high) of what is repeated, from rows sorted by their leading bytes."""
    names, types = ["number", "doc", "low", "high"], [pa.int64()] * 4
    waiting: list[pa.Table] = []

    def work(table: pa.Table) -> pa.RecordBatch:
        docs, places, numbers = (table.column(c).to_numpy() for c in ("doc", "place", "number"))
        lists = [table.column(c).to_pylist() for c in ("lead", "before", "after")]
        at, low, high = repeated_spans(*lists, docs, places)
        return _rows([numbers[at], docs[at], low, high], types, names)

    size = 0
    strings = _Strings()
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        ready = rows.filter(pa.compute.is_null(rows.column("lead")))
        if len(ready):
            yield from ready.select(names).combine_chunks().to_batches()
        single = rows.filter(pa.compute.and_(pa.compute.is_valid(rows.column("lead")), pa.compute.is_null(rows.column("after"))))
        if len(single):
            single = strings.later(single)
            starts = single.column("place").to_numpy()
            yield _rows([single.column("number").to_numpy(), single.column("doc").to_numpy(), starts, starts + LENGTH], types, names)
        rows = rows.filter(pa.compute.is_valid(rows.column("after")))
        if not len(rows):
            continue
        waiting.append(rows)
        size += len(rows)
        if size >= AT_ONCE:
            table = pa.concat_tables(waiting)
            last = table.column("lead")[-1]
            cut = len(table) - pa.compute.sum(pa.compute.equal(table.column("lead"), last)).as_py()
            if cut:
                yield work(table.slice(0, cut))
                waiting, size = [table.slice(cut)], len(table) - cut
    if size:
        yield work(pa.concat_tables(waiting))


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) per text."""
    open_ = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for key, packed, labels, spans in zip(*[batch.column(k).to_pylist() for k in range(4)]):
            data = open_.decompress(packed)
            doc = next(x["first_id"] for x in labels if x["key"] == key)
            gone = _joined([(s["low"], s["high"]) for s in spans or [] if s["doc"] == doc])
            kept, at = hashlib.sha256(), 0
            for low, high in gone:
                kept.update(data[at:low])
                at = high
            kept.update(data[at:])
            rows.append((key, len(data), sum(b - a for a, b in gone), len(gone), kept.hexdigest()))
        columns = list(zip(*rows)) or [[]] * 5
        yield _rows(
            columns,
            [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()],
            ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _hot(again: DataFrame, n: int) -> np.ndarray:
    """The sorted hashes of grams with more surroundings than a ``HOT_PARTS``-th of a task's share: ``HOT_PARTS * n`` of them at most,
    as each has more than so large a part of the sum."""
    total = again.filter("slot IS NULL").agg(F.sum("weight")).first()[0] or 0
    limit = max(HOT_LEAST - 1, total // (HOT_PARTS * n))
    rows = again.filter(F.col("slot").isNotNull() & (F.col("weight") > limit)).select("slot").toPandas()["slot"]
    return np.sort(rows.to_numpy().astype(np.int64).view(np.uint64))


def _splitters(texts: DataFrame, n_texts: int, n: int) -> np.ndarray:
    """The first eight bytes, as numbers, that part the suffixes of a random sample of bounded size into ``n`` buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leads = []
            for text in batch.column(0):
                data = text.as_py().encode("utf-8")
                at = anchors(data)[0]  # splitters change where rows go, not what is found
                at = at[:: -(-len(at) // SAMPLE_ANCHORS) or 1]
                leads += [int.from_bytes(data[p : p + 8], "big") - (1 << 63) for p in at.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(leads, pa.int64())], names=["lead"])

    part = texts.select("text").sample(min(1.0, SAMPLE_TEXTS / max(1, n_texts)), seed=7)
    sample = part.mapInArrow(run, "lead long").toPandas()["lead"].to_numpy()
    if not len(sample):
        return np.zeros(0, np.uint64)
    leads = np.sort(sample.astype(np.int64))
    cuts = leads[np.linspace(0, len(leads) - 1, n + 1).astype(int)[1:-1]]
    return np.unique(cuts.view(np.uint64) ^ np.uint64(1 << 63))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.unhex(F.md5(text)).alias("key"),
        F.octet_length(text).cast("long").alias("size"),
    )
    firsts = staged(rows.groupBy("key").agg(F.min("doc").alias("first_id"), F.count("*").alias("copies")))
    texts = docs.select(F.unhex(F.md5(text)).alias("key"), text.alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    hashed = texts.mapInArrow(_hashed, "slot long, at long, known boolean, weight int")
    again = staged(hashed.repartition("slot").sortWithinPartitions("slot").mapInArrow(_repeated, "at long, weight long, slot long"))
    places = again.filter("slot IS NULL").select(
        F.shiftrightunsigned("at", PLACE_BITS).alias("number"), F.col("at").bitwiseAND((1 << PLACE_BITS) - 1).alias("place")
    )
    places = places.groupBy("number").agg(F.collect_set("place").alias("places"))
    head = F.conv(F.substring(F.hex("key"), 1, 9), 16, 10).cast("long")
    labels = firsts.groupBy(head.alias("number")).agg(F.collect_list(F.struct("key", "first_id")).alias("labels"))
    # few bytes per text and per repeated place: written once, read by both passes over the texts
    known = staged(labels.join(places, "number", "left"))

    packed = texts.mapInArrow(_packed, "number long, key binary, packed binary").filter("number IS NOT NULL").repartition("number")
    asked = packed.join(known.filter("places IS NOT NULL"), "number").select("number", "key", "packed", "labels", "places")
    n_texts = firsts.agg(F.sum("copies")).first()[0] or 0
    suffixes = asked.mapInArrow(_suffixes(_splitters(texts, n_texts, n), _hot(again, n)), SUFFIX_DDL)
    # a bucket is a range of leading bytes and a task; what shares its leading bytes is in one
    dealt = suffixes.repartitionById(n, F.col("bucket")).sortWithinPartitions("lead", "doc", "place")
    spans = dealt.mapInArrow(_compared, "number long, doc long, low long, high long")
    spans = spans.groupBy("number").agg(F.collect_list(F.struct("doc", "low", "high")).alias("spans"))
    marked = known.select("number", "labels").join(spans, "number", "left")
    done = (
        packed.join(marked, "number")
        .select("key", "packed", "labels", "spans")
        .mapInArrow(_finished, "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )
    done = done.dropDuplicates(["key"]).join(firsts.drop("copies"), "key")
    copy = (F.col("doc") > F.col("first_id")) & (F.col("size") >= LENGTH)
    empty = hashlib.sha256(b"").hexdigest()
    return rows.join(done, "key").select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("size")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(copy, F.lit(empty)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
