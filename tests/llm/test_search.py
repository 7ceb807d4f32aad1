import math
import random
import re
from collections import Counter

import pytest

from reportgrid.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate({b: b + 32 for b in range(65, 91)}) for t in TERM.findall(text or "")]


def brute(docs, items, k=20):
    """Every document scored for every item."""
    known = [(i, Counter(t)) for i, text in docs if (t := terms(text))]
    n_docs, n_terms = len(known), sum(sum(t.values()) for _, t in known)
    df = Counter(w for _, t in known for w in t)
    out = []
    for item, text in items:
        found = []
        for i, t in known:
            n = sum(t.values())
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * t[w]) // (1000 * t[w] + 12 * m))
                for w in terms(text)
                if w in t
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def corpus(seed, n, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)] + ["Ünï", "東京", "A1"]
    texts = [" ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(len(vocabulary))], k=rng.randrange(1, 40))) for _ in range(n)]
    return [(k, t) for k, t in enumerate(texts)], [(k, " ".join(rng.choices(vocabulary, k=6))) for k in range(12)]


@pytest.mark.parametrize("shard, together, terms_in_block", [(1 << 19, 256, 100_000), (40, 1, 100_000), (300, 3, 4)])
def test_against_every_document_scored(spark, monkeypatch, shard, together, terms_in_block):
    monkeypatch.setattr(L, "SHARD", shard)
    monkeypatch.setattr(L, "TOGETHER", together)
    monkeypatch.setattr(L, "BLOCK_TERMS", terms_in_block)
    docs, items = corpus(3, 300)
    docs += [(1000 + k, docs[7][1]) for k in range(40)]  # ties beyond the end of the list
    docs = [*docs, docs[5], (None, docs[9][1]), (2000, None), (2001, "--- ..")]
    items = [*items, (3, "w1 w1 W1"), (3, "w1 w1 W1"), (50, None), (51, "unheard"), (52, docs[7][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in L.search(d, q).select("item_id", "rank", "doc_id", "score").collect()), key=str)
    assert got == brute(docs, items)


def test_range_maxima():
    import numpy as np

    rng = np.random.default_rng(1)
    impacts = [rng.integers(0, 9, n) for n in (1, 2, 7, 64, 33)]
    lists = L.Lists(np.arange(64), [np.arange(len(x)) for x in impacts], impacts)
    for k, start in enumerate(lists.start[:-1].tolist()):
        n = len(impacts[k])
        low, high = np.triu_indices(n)
        top = lists.top(start + low, start + high + 1)
        assert [lists.impact[t] for t in top] == [impacts[k][a : b + 1].max() for a, b in zip(low, high)]
        assert ((top >= start + low) & (top <= start + high)).all()


def test_few_documents_get_a_score(monkeypatch):
    """The bounds spare most documents."""
    import numpy as np

    rng = np.random.default_rng(5)
    n = 4000
    lists = [np.sort(rng.choice(n, 400, replace=False)) for _ in range(5)]
    impacts = [(1000 * rng.random(400) ** 8).astype(np.int64) + 1 for _ in range(5)]
    shard, best, scored = L.Lists(np.arange(n), lists, impacts), L.Best(5), []
    add = L.Best.add
    monkeypatch.setattr(L.Best, "add", lambda self, scores, ids: (scored.extend(ids), add(self, scores, ids)))
    monkeypatch.setattr(L, "TOGETHER", 4)
    L.search_shard(shard, np.arange(5), np.ones(5, np.int64), best)
    full = np.zeros(n, np.int64)
    for at, impact in zip(lists, impacts):
        full[at] += impact
    assert best.scores.tolist() == sorted(full.tolist(), reverse=True)[:5]
    assert len(scored) == len(set(scored)) < n // 8


def test_edges(spark, edge_docs, no_docs):
    asked = edge_docs.selectExpr("doc_id AS item_id", "text", "lang AS doc_id", "source AS score")
    got = L.search(edge_docs, asked).collect()
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, rows)
    assert L.search(no_docs, asked).collect() == []
    assert L.search(edge_docs, asked.limit(0)).collect() == []
    assert L.search(edge_docs, asked).columns == ["item_id", "rank", "doc_id", "score"]
