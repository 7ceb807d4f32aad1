import hashlib
import random

import numpy as np
import pytest

from reportgrid.llm import suffix_dedup as S


def slow(rows):
    """(id, text) by the definition: strings that start earlier, judged on the input."""
    first: dict[bytes, tuple[int, int]] = {}
    order = [(S.NO_ID if i is None else i, (t or "").encode()) for i, t in rows]
    for doc, data in sorted(order):
        for k in range(len(data) - S.LENGTH + 1):
            key = data[k : k + S.LENGTH]
            first[key] = min(first.get(key, (doc, k)), (doc, k))
    out = []
    for doc, data in order:
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - S.LENGTH + 1):
            if first[data[k : k + S.LENGTH]] < (doc, k):
                gone[k : k + S.LENGTH] = True
        kept = bytes(np.frombuffer(data, np.uint8)[~gone[:-1]])
        spans = int((np.diff(np.concatenate([[False], gone])) & gone).sum())
        out.append((len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows, parts=5):
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, key string").repartition(parts)
    got = [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in S.remove_repeats(docs).collect()]
    want = list(zip([i for i, _ in rows], slow(rows)))
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_passages_copies_and_periods(spark, monkeypatch):
    rng = random.Random(6)

    def text(n, letters="abcdefghij é"):
        return "".join(rng.choice(letters) for _ in range(n))

    passages = [text(n) for n in (99, 100, 101, 150, 260, 700)]
    rows = []
    for k in range(60):
        parts = [text(rng.randint(0, 250)) for _ in range(4)]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 20)
            parts.insert(rng.randint(0, len(parts)), p[a:] if rng.random() < 0.3 else p)
        rows.append((rng.choice([k, k * 7 - 100]), "".join(parts)))
    rows += [(1000 + k, rows[k][1]) for k in range(5)] + [(-50, rows[3][1])]
    rows += [(2000, "ab" * 300), (2001, "ab" * 300 + "c"), (2002, "x" * 500), (2003, "x" * 99), (2004, "x" * 100)]
    rows += [(2100, "ü" * 400), (2101, text(300, "ab") * 2), (2102, None), (2103, ""), (None, rows[0][1]), (None, "x" * 130)]
    rows += [rows[-3], rows[1], rows[1]]
    check(spark, rows)


def test_near_copies_in_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "HELD", 50)
    monkeypatch.setattr(S, "AT_ONCE", 60)
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh ") for _ in range(900))
    rows = []
    for k in range(90):
        if k % 3 == 0:
            at = rng.randrange(800)
            rows.append((k, base[:at] + rng.choice("XYZ") + base[at + rng.randint(0, 2) :]))
        else:
            rows.append((k, "".join(rng.choice("abcdefgh ") for _ in range(300))))
    check(spark, rows)


@pytest.mark.parametrize("length", [40, 90, 140, 230])
def test_a_phrase_in_a_third_of_all_rows_with_different_words_around(spark, monkeypatch, length):
    """Its anchors are hot, the strings around them are parted over the tasks, and no lead fills a task."""
    monkeypatch.setattr(S, "HOT_LEAST", 30)
    monkeypatch.setattr(S, "HELD_STRINGS", 3000)
    rng = random.Random(length)

    def text(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    phrase = text(length)
    ends = [text(60) for _ in range(4)]  # some of what stands around comes back, too
    rows = []
    for k in range(360):
        if k % 3 == 0:
            around = text(rng.randint(0, 120)), text(rng.randint(0, 120))
            if rng.random() < 0.2:
                around = around[0] + rng.choice(ends), rng.choice(ends) + around[1]
            rows.append((k, around[0] + phrase + around[1]))
        else:
            rows.append((k, text(200)))
    rows += [(700, phrase * 3), (700, phrase * 3), (None, phrase), (rows[0][0], rows[0][1])]
    seen = []
    hot = S._hot
    monkeypatch.setattr(S, "_hot", lambda again, n: seen.append(hot(again, n)) or seen[-1])
    check(spark, rows)
    assert len(seen[0]) and len(seen[0]) <= S.HOT_PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_weights_of_grams_over_batches():
    """Places that share a slot are told once each, and a slot's surroundings are summed over batches of any size."""
    rng = random.Random(4)
    slots = sorted(rng.choice(range(40)) for _ in range(300))
    rows = [(s, 1000 + k, rng.random() < 0.2, rng.randint(1, 40)) for k, s in enumerate(slots)]
    cuts = sorted(rng.sample(range(1, 300), 60)) + [300]
    batches, at = [], 0
    for cut in cuts:
        batches.append(S._rows(list(zip(*rows[at:cut])), [S.pa.int64(), S.pa.int64(), S.pa.bool_(), S.pa.int32()], list("sakw")))
        at = cut
    got = [r for b in S._repeated(iter(batches)) for r in b.to_pylist()]
    want = [(a, w) for s, a, known, w in rows if known or slots.count(s) > 1]
    assert sorted((r["at"], r["weight"]) for r in got if r["slot"] is None) == sorted(want)
    sums = {s: sum(r[3] for r in rows if r[0] == s) for s in slots}
    assert {r["slot"]: r["weight"] for r in got if r["slot"] is not None} == {s: w for s, w in sums.items() if w >= S.HOT_LEAST}


def test_edges_of_the_table(edge_docs, no_docs):
    rows = S.remove_repeats(edge_docs).collect()
    texts = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = sorted(repr((r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))) for r in rows)
    assert got == sorted(repr(x) for x in zip([i for i, _ in texts], slow(texts)))
    assert S.remove_repeats(no_docs).count() == 0


def test_every_string_holds_an_anchor_of_its_own():
    rng = random.Random(1)
    data = bytes(rng.choice(b"abcd") for _ in range(3000)) + b"ab" * 200
    at = set(S.anchors(data)[0].tolist())
    for k in range(len(data) - S.LENGTH + 1):
        alone = S.anchors(data[k : k + S.LENGTH])[0]
        assert len(alone) and all(k + p in at for p in alone.tolist())


def test_multikey_sort():
    rng = np.random.default_rng(3)
    strings = rng.integers(97, 99, (400, 80), np.uint8)
    strings[50:200] = strings[0]
    strings[60:100, 70] = 120
    groups = rng.integers(0, 4, 400)
    order, common = S.multikey_sort(groups, strings)
    keys = [(int(groups[k]), strings[k].tobytes()) for k in order]
    assert keys == sorted(keys)
    for j in range(1, 400):
        (g, a), (h, b) = keys[j - 1], keys[j]
        want = -1 if g != h else next((k for k in range(80) if a[k] != b[k]), 80)
        assert common[j] == want


@pytest.mark.parametrize("name", ["op7_suffix_dedup"])
def test_table(spark, sf_dir, name):
    from reportgrid.llm.queries import QUERIES

    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES[name](spark, sf_dir).collect()}
    assert got == dict(zip([i for i, _ in texts], slow(texts)))
