import random
import re

import numpy as np
import pytest
import xxhash

from reportgrid.llm import simhash
from reportgrid.llm.components import components


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(nodes, near):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "One two", "A b C d", "ÀÉ İ x y z " * 40, "w " * 40000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_masks_cover_every_pair():
    rng = random.Random(5)
    masks = simhash.first_masks()
    for _ in range(300):
        bits = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not bits & m for m in masks)
        first = next(m for m in masks if not bits & m)
        fine = simhash.fine_masks(first)
        assert any(not bits & m for m in fine)
        assert all((~m & (1 << 64) - 1).bit_count() <= 9 for m in fine)


@pytest.mark.parametrize("hot", [2, 256])
def test_links_connect_all_within_distance(spark, monkeypatch, hot):
    """Dense balls of fingerprints, with the refined keys in use and without."""
    monkeypatch.setattr(simhash, "HOT", hot)
    rng = random.Random(7)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(40)}
    signed = {f: int(np.uint64(f).astype(np.int64)) for f in fps}
    back = {s: f for f, s in signed.items()}
    frame = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    found = {r.node: r.root for r in components(simhash.links(frame)).collect()}
    want = slow_components(sorted(back), lambda a, b: (back[a] ^ back[b]).bit_count() <= 3)
    assert {n: found.get(n, n) for n in back} == want


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(200, 260)] + [(500, 500), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[k] for k in range(1, 61)} == {1}
    assert {found[k] for k in range(200, 260)} == {100}
    assert found[500] == 500


def test_edges_of_the_table(edge_docs, no_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == 12
    of = {r.doc_id: (r.fingerprint, r.component_id) for r in rows if r.doc_id is not None}
    assert of[2] == of[3] == of[6] == ("0" * 16, 2)
    assert of[5] == of[1] and of[1][1] == 1
    assert [r.component_id for r in rows if r.doc_id is None and r.fingerprint == of[1][0]] == [1]
    assert simhash.near_duplicates(no_docs).count() == 0


def test_table(spark, sf_dir):
    from reportgrid.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    fps = {i: slow_fingerprint(t) for i, t in texts.items()}
    want = slow_components(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash"](spark, sf_dir).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
