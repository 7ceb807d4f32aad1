"""Byte-pair encoding of whole texts, with chunks that documents share encoded once.

Texts are cut where a hash of the last few bytes has a certain value, so equal passages give equal chunks
wherever they stand. Equal texts are worked on once. A chunk that occurs in several places is encoded
by one of them, its owner, and the ids are sent to the others; all other chunks are encoded where the text
is. Ids of chunks encoded alone can differ at the joins, so each join is repaired: the stretch from the last word start before
it to the first word start after it is encoded again, and is taken if both neighbours have a token
boundary exactly there; otherwise the stretch grows by a word on that side, at worst to the whole text.

A word start is a space between two visible ASCII characters: no token of this kind of vocabulary spans one, whatever is around.

The vocabulary file (a constant of about a megabyte and a half) is read by the driver and sent along. Chunks of
letters up to the Latin blocks go to the faster of two libraries that agree there, all others, and those that may hold a special token, to the
one that defines the result.

Defined results: a null text is the empty text, which has no tokens; repeated rows get the same answer each; nulls
and repetitions in the id are kept; a text without word starts is encoded whole; all other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportgrid.llm.tables import remembered
from reportgrid.sources.staging import staged

#: A chunk ends where this many bits of the hash are zero, but not before ``LEAST_BYTES``.
CUT_BITS = 10
LEAST_BYTES = 256
WINDOW_ODD = np.uint64(0x9E3779B97F4A7C15)
WORD_START = re.compile(rb"(?<=[!-~]) (?=[!-~])")
#: Characters beyond the Latin blocks, and the beginning of a special token.
OTHER = re.compile(r"[^\x00-ɏ]|<\|")
#: Splits a text as the byte-level vocabulary does: fixed value of the format.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Both libraries over one vocabulary file."""

    def __init__(self, vocabulary: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(vocabulary)
        self.whole.no_truncation()
        self.whole.no_padding()
        spec = json.loads(vocabulary)
        letters = _byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in piece): n for piece, n in spec["model"]["vocab"].items() if piece not in self.special
        }
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        size = max([*ranks.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for piece, n in [*ranks.items(), *((t.encode(), n) for t, n in self.special.items())]:
            self.bytes_of[n] = piece
        self.length_of = np.array([len(p) for p in self.bytes_of], np.int64)
        self.name_of = [str(n) for n in range(size)]
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32

    def encode(self, data: bytes) -> np.ndarray:
        text = data.decode("utf-8")
        if OTHER.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.kind)
        return np.array(self.fast.encode_ordinary(text), self.kind)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, by its rule: printable ones for themselves, others from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def encoder(vocabulary: str) -> Encoder:
    return remembered("bpe " + hashlib.md5(vocabulary.encode()).hexdigest(), lambda: Encoder(vocabulary))


def cuts(data: bytes) -> list[int]:
    """Where chunks begin and end: 0, the cuts, and the length."""
    n = len(data)
    if n <= LEAST_BYTES:
        return [0, n] if n else [0]
    a = np.frombuffer(data, np.uint8).astype(np.uint64)
    two = a[:-1] | (a[1:] << np.uint64(8))
    four = two[:-2] | (two[2:] << np.uint64(16))
    eight = four[:-4] | (four[4:] << np.uint64(32))
    eight *= WINDOW_ODD
    at = np.flatnonzero((eight >> np.uint64(64 - CUT_BITS)) == 0) + 8
    out = [0]
    for cut in at.tolist():
        if cut - out[-1] >= LEAST_BYTES and n - cut >= LEAST_BYTES and data[cut] & 0xC0 != 0x80:
            out.append(cut)
    return [*out, n]


def _starts(data: bytes, low: int, high: int) -> list[int]:
    return [m.start() for m in WORD_START.finditer(data, max(0, low - 1), min(len(data), high + 1)) if low < m.start() < high]


def repaired(data: bytes, places: list[int], parts: list[np.ndarray], by: Encoder) -> np.ndarray:
    """The ids of the whole text from those of its chunks, each encoded alone."""
    if len(parts) < 2:
        return parts[0] if parts else np.zeros(0, by.kind)
    ends = [np.cumsum(by.length_of[p]) + places[k] for k, p in enumerate(parts)]
    out: list[np.ndarray] = []
    chunk, skip = 0, 0  # the first ``skip`` tokens of this chunk are replaced already
    while chunk < len(parts) - 1:
        low, high = places[chunk], places[chunk + 1]
        begun = int(ends[chunk][skip - 1]) if skip else low
        left = keep = None
        back = 256
        while left is None and back < 2 * (high - begun) + 512:
            for p in reversed(_starts(data, max(begun - 1, high - back), high)):
                k = int(np.searchsorted(ends[chunk], p))
                if p > begun and k < len(ends[chunk]) and ends[chunk][k] == p:
                    left, keep = p, k + 1
                    break
            back *= 2
        if left is None:
            left, keep = begun, skip  # the chunk has no word start of its own: all of it is encoded again
        right, to, drop = len(data), len(parts), 0
        for k in range(chunk + 1, len(parts)):
            found = None
            reach = 256
            while found is None and reach < 2 * (places[k + 1] - places[k]) + 512:
                for q in _starts(data, places[k], min(places[k + 1], places[k] + reach)):
                    j = int(np.searchsorted(ends[k], q))
                    if j < len(ends[k]) and ends[k][j] == q:
                        found = q, j + 1
                        break
                reach *= 2
            if found:
                right, drop = found
                to = k
                break
        out.append(parts[chunk][skip:keep])
        out.append(by.encode(data[left:right]))
        chunk, skip = to, drop
    if chunk < len(parts):
        out.append(parts[chunk][skip:])
    return np.concatenate(out)


def _digest(data: bytes) -> bytes:
    return hashlib.md5(data).digest()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, text, place, mark) of every chunk of texts not seen before in this task."""
    seen: set[bytes] = set()
    for batch in batches:
        rows: list[tuple[bytes, bytes, int, int]] = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if key in seen:
                continue
            seen.add(key)
            data = text.as_py().encode("utf-8")
            places = cuts(data)
            for low, high in zip(places, places[1:]):
                mark = int.from_bytes(_digest(key + low.to_bytes(8, "big"))[:8], "big", signed=True)
                rows.append((_digest(data[low:high]), key, low, mark))
        types = [pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["digest", "key", "place", "mark"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts, each once a task, compressed: they are shuffled whole."""
    seen: set[bytes] = set()
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        rows = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if key not in seen:
                seen.add(key)
                rows.append((key, squeeze.compress(text.as_py().encode("utf-8"))))
        columns = list(zip(*rows)) or [[]] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["key", "packed"])


def _text(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def encoded(docs: DataFrame, vocabulary: str, text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per different text: ``key`` (its digest), ``n_tokens, ids_sha256, decoded_sha256``, and the ids if asked for."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(vocabulary)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.unhex(F.md5(text)).alias("key"), text.alias("text"))
    chunks = staged(texts.mapInArrow(_chunks, "digest binary, key binary, place long, mark long"))
    # a chunk in two places has two marks; the place with the least one owns it
    shared = chunks.groupBy("digest").agg(F.min("mark").alias("least"), F.max("mark").alias("most"))
    shared = shared.filter("least <> most").select("digest", "least")
    uses = chunks.join(shared, "digest").select("digest", "key", "place", (F.col("mark") == F.col("least")).alias("owned"))
    uses = staged(uses)
    # both readers of the texts share this one exchange; without the filter, which drops nothing, one of them would get it alone
    packed = texts.mapInArrow(_packed, "key binary, packed binary").filter("key IS NOT NULL").repartition("key")
    owned = uses.filter("owned").groupBy("key").agg(F.collect_set(F.struct("place", "digest")).alias("owned"))

    def encode_owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = encoder(sent.value)
        for batch in batches:
            digests, ids = [], []
            for text, places in zip(batch.column(0), batch.column(1).to_pylist()):
                data = _text(text.as_py())
                bounds = cuts(data)
                after = dict(zip(bounds, bounds[1:]))
                for place in places:
                    digests.append(place["digest"])
                    ids.append(by.encode(data[place["place"] : after[place["place"]]]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(ids, pa.binary())], names=["digest", "ids"])

    known = packed.join(owned, "key").select("packed", "owned").mapInArrow(encode_owned, "digest binary, ids binary")
    given = uses.join(known, "digest").groupBy("key").agg(F.collect_set(F.struct("place", "ids")).alias("given"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = encoder(sent.value)
        last = None
        for batch in batches:
            rows = []
            for key, text, parts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if key == last:
                    continue  # the same text from another task; rows come sorted
                last = key
                data = _text(text.as_py())
                had = {p["place"]: np.frombuffer(p["ids"], by.kind) for p in parts.as_py() or []}
                bounds = cuts(data)
                # chunks nobody else has need no joins between them: they are encoded together
                places, pieces = [], []
                for low, high in zip(bounds, bounds[1:]):
                    if low in had or not places or places[-1] in had:
                        places.append(low)
                places.append(len(data))
                for low, high in zip(places, places[1:]):
                    pieces.append(had[low] if low in had else by.encode(data[low:high]))
                ids = repaired(data, places, pieces, by).tolist()
                names, letters = by.name_of, by.bytes_of
                rows.append(
                    (
                        key,
                        len(ids),
                        hashlib.sha256(",".join([names[n] for n in ids]).encode()).hexdigest(),
                        hashlib.sha256(b"".join([letters[n] for n in ids])).hexdigest(),
                        ids if with_ids else None,
                    )
                )
            types = [pa.binary(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())][: 4 + with_ids]
            columns = (list(zip(*rows)) or [[]] * 5)[: len(types)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names_out[: len(types)])

    names_out = ["key", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    shape = "key binary, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    found = packed.join(given, "key", "left").select("key", "packed", "given").mapInArrow(finish, shape)
    return found.dropDuplicates(["key"]) if not with_ids else found.groupBy("key").agg(
        *[F.first(c).alias(c) for c in names_out[1:]]
    )


def encode_documents(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per row of ``docs``: the id, and what its text's ids are; with ``with_ids`` the ids themselves."""
    found = encoded(docs, vocabulary, text_col, with_ids)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.md5(text)).alias("key"))
    return rows.join(found, "key").drop("key")


def decode(ids: list[int], vocabulary: str) -> str:
    letters = encoder(vocabulary).bytes_of
    return b"".join([letters[n] for n in ids]).decode("utf-8", "replace")
