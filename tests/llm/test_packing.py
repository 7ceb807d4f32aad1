import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from reportgrid.llm import packing
from reportgrid.llm.queries import vocabulary


def brute(lengths, capacity):
    """The rule, word by word: all squares summed anew for every open sequence."""
    gaps, out = [], []
    for n in lengths:
        best = None
        for number, gap in enumerate(gaps):
            if gap >= n:
                after = Counter(g for k, g in enumerate(gaps) if k != number and g)
                after[gap - n] += gap > n
                rank = sum(c * c for c in after.values()), gap
                best = min(best or (rank, number), (rank, number))
        if best:
            rank = best[0]
            out.append((n, rank[1]))
            gaps[next(k for k, g in reversed(list(enumerate(gaps))) if g == rank[1])] -= n
        else:
            out.append((n, capacity))
            gaps.append(capacity - n)
    return out, len(gaps)


@pytest.mark.parametrize("seed", range(8))
def test_sums_of_squares(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 7, 20])
    lengths = [rng.randint(1, capacity) for _ in range(70)]
    if seed % 2:
        lengths.sort(reverse=True)
    got = packing.place_all(lengths, capacity)
    want, n = brute(lengths, capacity)
    assert [(length, capacity - offset) for length, (_, offset) in zip(lengths, got)] == want
    assert len({number for number, _ in got}) == n


def test_spans():
    assert packing.spans(1, 4) == [(0, 1)]
    assert packing.spans(4, 4) == [(0, 4)]
    assert packing.spans(9, 4) == [(0, 1), (1, 4), (5, 4)]
    assert packing.spans(8, 4) == [(0, 4), (4, 4)]


def check(rows, docs, capacity):
    """Pieces hold their documents' ids in order; sequences are gapless and not too long."""
    whole = Tokenizer.from_str(vocabulary())
    want = Counter()
    for id_, text in docs:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        for piece, (start, n) in enumerate(packing.spans(len(ids), capacity)):
            crc = zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
            want[id_, piece, start, n, crc] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end += n
        assert end <= capacity
    return len(held)


@pytest.mark.parametrize("group", [1 << 16, 50])
def test_round_trip(spark, sf_dir, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP", group)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = packing.pack(docs, vocabulary()).collect()
    n = check(rows, [tuple(r) for r in docs.collect()], 1024)
    least = -(-sum(r["length"] for r in rows) // 1024)
    assert n <= least * (1.02 if group > 1000 else 1.1) + 1


def test_edges(spark, edge_docs, no_docs):
    rows = packing.pack(edge_docs, vocabulary(), capacity=16).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in edge_docs.collect()], 16)
    assert packing.pack(no_docs, vocabulary()).collect() == []
    assert packing.pack(no_docs, vocabulary()).columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
    ]
    with pytest.raises(ValueError):
        packing.pack(edge_docs, vocabulary(), capacity=0)
