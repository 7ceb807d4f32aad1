"""Which tokens of two tokenizers lie over the same bytes, and which pairs of them the corpus links.

Both encode a text into tokens that cover the same bytes. Every byte offset where tokens of both end is a cut; the
tokens between two cuts are a group. The cuts are found by divide and conquer: in an interval of tokens one common end near its
middle is looked up, by bisection among the ends of the other tokenizer, and both halves are searched in the same way; an
interval without a common end inside is a leaf, a group. All intervals of a batch of texts take their next step together.
An interval that shows no common end after ``STEPS`` lookups around its middle has all its ends looked up at once, and falls
in two at the common end nearest to its middle, so that a long text with few cuts or none takes no longer than sorting it would.

The two tokens that end at a cut are a link. How often the corpus holds a pair of ids linked is counted over all texts
by an aggregate. The counts come back to the documents in two ways: those of pairs that hold at least one link in ``FREQUENT``, of which
there can be no more than ``FREQUENT``, are broadcast; all others are joined, and none of these can be a hot key.

Defined results: texts that are null, empty, or that one tokenizer does not give back byte by byte have no tokens, zeros and an
empty string; each of repeated rows, and each row without an id, is a document of its own; no rows give no rows. All
columns but the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportgrid.llm.word_encoding import ByteLevel, Letters, Pieces, Words, byte_level, regular
from reportgrid.llm.word_encoding import pieces as piece_model
from reportgrid.sources.staging import staged

#: Ends looked up one by one beside the middle of an interval.
STEPS = 16
#: A pair is frequent if it holds at least one link in so many.
FREQUENT = 1 << 16
#: Bytes of text that are aligned together.
SLAB = 1 << 18


def cuts(a_ends: np.ndarray, b_ends: np.ndarray, a_parts: np.ndarray, b_parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the tokens, in ``a`` and in ``b``, that end together.

    Ends ascend over all texts of a batch; text ``k`` has the tokens from ``a_parts[k]`` to ``a_parts[k + 1]``, of ``b``
    alike, and its last tokens end together.
    """
    low, high = a_parts[:-1], a_parts[1:] - 1  # the last token of an interval is a cut already
    b_low, b_high = b_parts[:-1], b_parts[1:] - 1
    found = [np.stack([high, b_high])]
    step = np.zeros(len(low), np.int32)
    while True:
        # a leaf has no end left to look up, or a single token on the other side
        going = (step < high - low) & (b_low < b_high)
        low, high, b_low, b_high, step = low[going], high[going], b_low[going], b_high[going], step[going]
        if not len(low):
            break
        n = high - low
        of = np.flatnonzero(step >= STEPS)
        if len(of):
            first = np.cumsum(n[of]) - n[of]
            at = np.arange(n[of].sum()) + np.repeat(low[of] - first, n[of])
            ends = a_ends[at]
            b_at = np.searchsorted(b_ends, ends)
            common = b_ends[b_at] == ends
            apart = np.where(common, np.abs(at - np.repeat(low[of] + (n[of] - 1) // 2, n[of])), len(a_ends))
            near = np.lexsort((apart, np.repeat(of, n[of])))[first]
            step[of] = n[of]
            near, of = near[common[near]], of[common[near]]
            at, b_at = at[near], b_at[near]
        else:
            # the token in the middle, then those to its right and left in turns
            at = low + (n - 1) // 2 + np.where(step % 2 == 1, (step + 1) // 2, -(step // 2))
            ends = a_ends[at]
            b_at = np.searchsorted(b_ends, ends)
            of = np.flatnonzero(b_ends[b_at] == ends)
            step += 1
            at, b_at = at[of], b_at[of]
        found.append(np.stack([at, b_at]))
        # a common end parts an interval in two; all stay in the order of the text
        twice = np.ones(len(low), np.int32)
        twice[of] = 2
        right = np.cumsum(twice)[of] - 1
        low, high, b_low, b_high, step = (np.repeat(x, twice) for x in (low, high, b_low, b_high, step))
        high[right - 1], b_high[right - 1], low[right], b_low[right] = at, b_at, at + 1, b_at + 1
        step[right - 1] = step[right] = 0
    places = np.concatenate(found, axis=1)
    return tuple(places[:, np.argsort(places[0])])


class Aligner:
    """Both tokenizers and the texts of their ids."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b, self.words = a, b, Words(a, b)
        self.letters = Letters(a), Letters(b)
        width = len(str(max(len(a.bytes_of), len(b.bytes_of)))) + 1
        # each id with the sign behind it: , inside a side of a group, | and ; after its last one
        self.a_names, self.b_names = (
            np.array([f"{n}{sign}" for sign in signs for n in range(len(side.bytes_of))], f"S{width}")
            for side, signs in ((a, ",|"), (b, ",;"))
        )

    def by_word(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """The ids of regular texts by both, None for a text that one does not give back."""
        words = [text.split(" ") for text in texts]
        numbers = self.words.numbers([word for some in words for word in some])
        parts = np.cumsum([0, *map(len, words)])
        spelled = self.words.sides[0].spelled[numbers] & self.words.sides[1].spelled[numbers]
        ids = []
        for side in self.words.sides:
            ends = np.concatenate([[0], np.cumsum(side.length[numbers])])[parts].tolist()
            tokens = side.tokens(numbers)
            ids.append([tokens[low:high] for low, high in zip(ends, ends[1:])])
        good = np.logical_and.reduceat(spelled, parts[:-1]).tolist()
        return [both if fine else None for fine, *both in zip(good, *ids)]

    def whole(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of a text by both, or None if there is no text or one does not give it back."""
        if not text:
            return None
        data = b" " + text.encode()
        both = self.a.encode_after_space(text), self.b.encode_after_space(text)
        return both if all(side.spell(ids, data) for side, ids in zip(self.letters, both)) else None

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        plain = [bool(text) and self.b.by_word and regular(text.encode()) for text in texts]
        by_word = iter(self.by_word([text for text, fine in zip(texts, plain) if fine]) if any(plain) else ())
        return [next(by_word) if fine else self.whole(text) for text, fine in zip(texts, plain)]

    def names(self, a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> np.ndarray:
        """The ids of each group in turn, those of ``a`` first, with the signs behind them."""
        out = np.empty(len(a) + len(b), self.a_names.dtype)
        a_more, b_more = np.full(len(a), 0), np.full(len(b), 0)
        a_more[a_cuts], b_more[b_cuts] = len(self.a.bytes_of), len(self.b.bytes_of)
        a_size, b_size = np.diff(a_cuts, prepend=-1), np.diff(b_cuts, prepend=-1)
        out[np.arange(len(a)) + np.repeat(b_cuts + 1 - b_size, a_size)] = self.a_names[a + a_more]
        out[np.arange(len(b)) + np.repeat(a_cuts + 1, b_size)] = self.b_names[b + b_more]
        return out

    def align(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, list[int], list[int], list[int]]]:
        """Per text: numbers of tokens and groups, digest of the groups, and its pairs of linked ids with how often each is linked."""
        read = self.tokens(texts)
        known = [both for both in read if both]
        if known:
            a, b = (np.concatenate(side).astype(np.int64) for side in zip(*known))
            a_parts, b_parts = (np.cumsum([0, *map(len, side)]) for side in zip(*known))
            # offsets in all texts one after the other: ends of different texts never meet
            a_cuts, b_cuts = cuts(np.cumsum(self.a.length_of[a]), np.cumsum(self.b.length_of[b]), a_parts, b_parts)
            bounds = np.searchsorted(a_cuts, a_parts).tolist()
            names = self.names(a, b, a_cuts, b_cuts)
            links = a[a_cuts] << 32 | b[b_cuts]
            parts = (a_parts + b_parts).tolist()
        k = 0
        for both in read:
            if not both:
                yield 0, 0, 0, "", [], [], []
                continue
            text = names[parts[k] : parts[k + 1]].tobytes().replace(b"\0", b"")[:-1]
            pairs, times = np.unique(links[bounds[k] : bounds[k + 1]], return_counts=True)
            n_groups = bounds[k + 1] - bounds[k]
            yield len(both[0]), len(both[1]), n_groups, hashlib.sha256(text).hexdigest(), pairs >> 32, pairs & 0xFFFFFFFF, times
            k += 1


def linked(docs: DataFrame, vocabulary: str, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: a number ``row`` of its own, ``doc_id``, the counts, ``groups_sha256`` and ``pairs`` (``a_id, b_id, times``)."""
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, model))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pair = pa.struct([("a_id", pa.int32()), ("b_id", pa.int32()), ("times", pa.int64())])
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Aligner(byte_level(sent.value[0], plain=True), piece_model(sent.value[1]))
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            low = 0
            while low < len(batch):
                high, texts, size = low, [], 0
                while high < len(batch) and size < SLAB:
                    texts.append(batch.column(1)[high].as_py())
                    size += len(texts[-1] or "")
                    high += 1
                n_a, n_b, n_groups, digests, a_ids, b_ids, times = zip(*by.align(texts))
                ends = np.cumsum([0, *map(len, times)]).astype(np.int32)
                fields = [np.concatenate(c).astype(t) for c, t in ((a_ids, np.int32), (b_ids, np.int32), (times, np.int64))]
                pairs = pa.StructArray.from_arrays([pa.array(c) for c in fields], fields=list(pair))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + high - low)),
                        batch.column(0).slice(low, high - low),
                        *[pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups)],
                        pa.array(digests, pa.string()),
                        pa.ListArray.from_arrays(pa.array(ends), pairs),
                    ],
                    names=names,
                )
                row += high - low
                low = high

    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<struct<a_id:int,b_id:int,times:long>>"
    return rows.mapInArrow(run, shape)


def pair_counts(docs: DataFrame) -> DataFrame:
    """How many links of the corpus hold each pair of ids: ``a_id, b_id, count``, and whether no pair with this ``b_id`` holds more."""
    counts = docs.select(F.inline("pairs")).groupBy("a_id", "b_id").agg(F.sum("times").alias("count"))
    # a window holds at most the vocabulary of the other tokenizer
    most = F.max("count").over(Window.partitionBy("b_id"))
    return counts.withColumn("best", F.col("count") == most)


def align(docs: DataFrame, vocabulary: str, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    found = staged(linked(docs, vocabulary, model, id_col, text_col))
    counts = staged(pair_counts(found))
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first()["n"]
    frequent = F.col("count") * FREQUENT >= F.lit(total)
    links = found.select("row", F.inline("pairs"))
    value = [F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("count")).alias("count_sum")]
    both = links.join(F.broadcast(counts.filter(frequent)), ["a_id", "b_id"], "left")
    near = both.filter("count IS NOT NULL").select("row", *value)
    far = both.filter("count IS NULL").select("row", "a_id", "b_id", "times").join(counts.filter(~frequent), ["a_id", "b_id"])
    sums = near.unionByName(far.select("row", *value)).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return found.drop("pairs").join(sums, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
