"""Near-duplicates by SimHash fingerprints that differ in few bits.

A fingerprint has 64 bits. It is split into blocks, of which two fingerprints with at most ``DISTANCE``
differing bits must share all but ``DISTANCE``: keys are made of every choice of the shared blocks, fingerprints with an
equal key are compared by Hamming distance. Equal fingerprints are one node from the start, however many
documents have them. Where more than ``HOT`` fingerprints share a key, the key is refined: the bits it leaves open are split
into blocks of three bits, and a key is made of every choice of all but ``DISTANCE`` of these. At most 9 bits are
open then, so such a group has at most 512 fingerprints whatever the data. Groups give a spanning forest of
their links, never all pairs.

Defined results: a text without words has fingerprint zero and is linked like any other; null is the empty
text; with fewer than three words the whole sequence is the only shingle; repeated rows have the same
component; rows without an id get the component of their fingerprint, and do not name it unless no row with an id is in it (it is null then);
all other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportgrid.llm.components import components
from reportgrid.sources.staging import staged

DISTANCE = 3
SHINGLE = 3
SEED = 42
#: Sizes in bits of the blocks of the first keys; two of them stay equal.
BLOCKS = (13, 13, 13, 13, 12)
#: Fingerprints with an equal first key that are compared at once; above, the key is refined.
HOT = 256
#: Bits of a block when a key is refined.
FINE_BITS = 3
#: Hashes whose bits are counted at once.
STEP = 1 << 14
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: str | None) -> np.ndarray:
    """Unsigned hashes of the shingles, repeats included."""
    words = (text or "").encode("utf-8").translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    ends, at = [], 0
    for word in words:
        at += len(word)
        ends.append(at)
        at += 1
    begins = [0, *[e + 1 for e in ends]]
    found = [digest(joined[a:b], SEED) for a, b in zip(begins, ends[SHINGLE - 1 :])]
    return np.fromiter(found, np.uint64, len(found))


def fingerprint(text: str | None) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    hashes = shingle_hashes(text)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), STEP):
        part = hashes[k : k + STEP].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id`` and the fingerprint ``fp`` as a signed long."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


def _masks(blocks: list[int], free: int) -> list[int]:
    """Every mask that leaves all but ``free`` of the blocks, given as masks themselves."""
    out = []
    for chosen in combinations(blocks, len(blocks) - free):
        mask = 0
        for block in chosen:
            mask |= block
        out.append(mask)
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def first_masks() -> list[int]:
    blocks, at = [], 0
    for size in BLOCKS:
        blocks.append(((1 << size) - 1) << at)
        at += size
    return _masks(blocks, DISTANCE)


def fine_masks(first: int) -> list[int]:
    """Masks that fix what ``first`` fixes, and all but ``DISTANCE`` blocks of the rest."""
    left = [b for b in range(64) if not first >> b & 1]
    blocks = [sum(1 << b for b in left[k : k + FINE_BITS]) for k in range(0, len(left), FINE_BITS)]
    return [first | m for m in _masks(blocks, DISTANCE)]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group of fingerprints, links that join what can be reached by steps within the distance."""
    for batch in batches:
        left, right = [], []
        for group in batch.column(0).to_pylist():
            fps = np.array(group, np.int64).view(np.uint64)
            root = np.arange(len(fps))
            if len(fps) == 2:
                if int(fps[0] ^ fps[1]).bit_count() <= DISTANCE:
                    left.append(group[0])
                    right.append(group[1])
                continue
            near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= DISTANCE
            todo = np.ones(len(fps), bool)
            for k in range(len(fps)):
                if not todo[k]:
                    continue
                reached = front = np.zeros(len(fps), bool)
                front = front.copy()
                front[k] = True
                reached = front.copy()
                while front.any():
                    front = near[front].any(axis=0) & ~reached
                    reached |= front
                todo &= ~reached
                root[reached] = k
            for k in np.flatnonzero(root != np.arange(len(fps))).tolist():
                left.append(group[int(root[k])])
                right.append(group[k])
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _groups(keyed: DataFrame, low: int, high: int | None) -> DataFrame:
    """The rows whose key has so many fingerprints."""
    sizes = keyed.groupBy("way", "key").agg(F.count("*").alias("n")).filter(F.col("n") >= low)
    if high is not None:
        sizes = sizes.filter(F.col("n") <= high)
    return keyed.join(sizes.drop("n"), ["way", "key"])


def links(fps: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that connect every two of the distinct fingerprints ``fp`` within the distance, directly or in steps."""

    def keyed(rows: DataFrame, masks: list[int]) -> DataFrame:
        ways = F.array(*[F.lit(_signed(m)) for m in masks])
        rows = rows.select("fp", F.posexplode(ways).alias("way", "mask"))
        return rows.select("way", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")

    def forest(groups: DataFrame) -> DataFrame:
        return groups.groupBy("way", "key").agg(F.collect_list("fp").alias("fps")).select("fps").mapInArrow(_forest, "a long, b long")

    first = staged(keyed(fps, first_masks()))
    hot = staged(_groups(first, HOT + 1, None))
    found = forest(_groups(first, 2, HOT))
    # the few masks are constants; the refined keys of one first key stay apart by carrying its number
    fine = F.create_map(
        *[x for k, m in enumerate(first_masks()) for x in (F.lit(k), F.array(*[F.lit(_signed(f)) for f in fine_masks(m)]))]
    )
    refined = hot.select("way", "fp", F.posexplode(fine[F.col("way")]).alias("choice", "mask")).select(
        (F.col("way") * 1000 + F.col("choice")).alias("way"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"
    )
    return found.unionByName(forest(_groups(refined, 2, None)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the least id that can be reached."""
    rows = staged(fingerprints(docs, id_col, text_col))
    firsts = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(firsts.select("fp")))
    placed = firsts.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = placed.join(named, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
