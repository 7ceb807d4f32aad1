import random

import pytest

from reportgrid.llm import decontaminate as D


def slow_edits(item, text):
    before = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (a != b)))
        before = now
    return min(before), before.index(min(before))


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(400):
        item = [rng.randrange(6) for _ in range(rng.randint(1, 70))]
        text = [rng.randrange(6) for _ in range(rng.randint(0, 90))]
        assert D.edits(item, text) == slow_edits(item, text)


def changed(rng, words, n, others):
    words = list(words)
    for _ in range(n):
        k, kind = rng.randrange(len(words)), rng.random()
        if kind < 1 / 3:
            words[k] = rng.choice(others)
        elif kind < 2 / 3:
            del words[k]
        else:
            words.insert(k, rng.choice(others))
    return words


@pytest.fixture(scope="module")
def planted(spark):
    """Items in documents with none to all of the allowed edits; the documents' other words are as common as the items'."""
    rng = random.Random(5)
    others = [f"w{min(int(rng.expovariate(0.02)), 400)}" for _ in range(4000)]
    items = [(k, [rng.choice(others) for _ in range(rng.randint(10, 60))]) for k in range(30)]
    rows, true = [], []
    for number in range(240):
        k, item = items[number % 30]
        n = rng.randint(0, int(D.MAX_EDITS * len(item)))
        body = [rng.choice(others) for _ in range(80)] + changed(rng, item, n, others) + [rng.choice(others) for _ in range(80)]
        rows.append((number, " ".join(body).replace("w7 ", "W7,\n")))
    rows += [(1000 + n, " ".join(rng.choice(others) for _ in range(200))) for n in range(60)]
    for i, text in rows:
        words = D.WORD.findall(text.lower())
        for k, item in items:
            if slow_edits(item, words)[0] <= int(D.MAX_EDITS * len(item)):
                true.append((i, k))
    return rows, [(k, " ".join(x)) for k, x in items], set(true)


def test_recall_and_exactness(spark, planted):
    rows, items, true = planted
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = D.leaks(docs, bench).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got <= true
    assert len(got) >= 0.97 * len(true) and len(true) >= 240
    texts, asked = dict(rows), dict(items)
    for r in found:
        assert r.edits >= slow_edits(D.WORD.findall(asked[r.item_id]), D.WORD.findall(texts[r.doc_id].lower()))[0]


def test_blocks_of_the_benchmark_give_the_same(spark, planted, monkeypatch):
    rows, items, _ = planted
    docs = spark.createDataFrame(rows[:60], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(D.leaks(docs, bench).collect())
    monkeypatch.setattr(D, "BLOCK_WORDS", 200)
    assert sorted(D.leaks(docs, bench).collect()) == one


def test_edges_of_the_table(spark, edge_docs, no_docs):
    passage = edge_docs.filter("doc_id = 1").first().text
    bench = spark.createDataFrame(
        [(1, passage), (1, passage), (2, "too short"), (3, None), (None, passage), (4, "zero " * 30), (5, "")],
        "item_id long, text string",
    )
    rows = D.leaks(edge_docs, bench).collect()
    # item 4 is one word 30 times over, which document 8 repeats
    assert sorted((r.doc_id or -1, r.item_id, r.edits) for r in rows) == [(-1, 1, 0), (1, 1, 0), (5, 1, 0), (5, 1, 0), (8, 4, 0)]
    assert D.leaks(no_docs, bench).count() == 0
    assert D.leaks(edge_docs, bench.limit(0)).count() == 0


def test_exact_items_of_the_table_are_all_found(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    items = bench.collect()
    want = {(d.doc_id, b.item_id) for d in docs.collect() for b in items if b.text in (d.text or "")}
    assert want <= {(r.doc_id, r.item_id) for r in D.leaks(docs, bench).collect()}


def test_pieces_are_more_than_the_edits():
    for n in range(2, 300):
        cut = D.pieces(n)
        assert len(cut) == int(D.MAX_EDITS * n) + 1 and cut[0][0] == 0 and cut[-1][1] == n
        assert all(a < b for a, b in cut) and all(x[1] == y[0] for x, y in zip(cut, cut[1:]))


def test_short_items_and_items_of_few_words_are_all_found(spark):
    """Every place within the edits allowed, against brute force."""
    rng = random.Random(8)
    others = [f"w{min(int(rng.expovariate(0.02)), 400)}" for _ in range(2000)]
    items = [(1, "What is the capital of France?".split()), (2, ["yes", "no"]), (3, ["yes", "no", "yes"] * 8), (4, list("aabb") * 6)]
    items += [(10 + k, [rng.choice(others[:300]) for _ in range(n)]) for k, n in enumerate([3, 4, 5, 6, 7, 8, 9, 10, 11, 12] * 2)]
    items += [(40 + k, [rng.choice("abc") for _ in range(n)]) for k, n in enumerate([5, 9, 14, 20, 33])]
    items += [(50 + k, ["echo"] * n) for k, n in enumerate([2, 3, 5, 6, 9, 10, 30])] + [(60, ["paris"])]
    rows = []
    for number in range(180):
        k, item = items[number % len(items)]
        inside = changed(rng, item, rng.randint(0, int(D.MAX_EDITS * len(item))), others + ["yes", "a"])
        body = [rng.choice(others) for _ in range(30)] + inside + [rng.choice(others) for _ in range(30)]
        rows.append((number, " ".join(body)))
    rows.append((500, "Who knows: what IS the capital,\nof France"))
    want = set()
    for i, text in rows:
        words = D.WORD.findall(text.lower())
        for k, item in items:
            item = D.WORD.findall(" ".join(item).lower())
            if (n := slow_edits(item, words))[0] <= int(D.MAX_EDITS * len(item)):
                want.add((i, k, *n))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.edits, r.end_word) for r in D.leaks(docs, bench).collect()}
    assert (500, 1, 0, 8) in got and len(want) >= 181
    assert got == want


def test_words_are_those_of_the_pattern(monkeypatch):
    """The hashes tell the same words apart that the pattern finds, wherever a text is cut."""
    monkeypatch.setattr(D, "SLICE", 50)
    D._slice_powers.cache_clear()
    every = "".join(map(chr, range(0x110000)))
    assert {chr(c) for c in D.np.flatnonzero(D._word_characters())} == set(D.re.findall(r"\w", every))
    rng = random.Random(3)
    known: dict[str, int] = {}
    for _ in range(300):
        letters = rng.choice(["ab", "aBc_1", "äß東京Σİ9", "xyz'\u0301\U00010400"])
        text = "".join(rng.choice(letters + " \n.-") for _ in range(rng.choice([0, 1, 49, 50, 51, 400])))
        text += rng.choice(["", "w" * 120, " tail"])
        words, hashes = D.WORD.findall(text.lower()), D.word_hashes(text)
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known) > 1000 and 0 not in known.values()
    D._slice_powers.cache_clear()
    assert len(D.word_hashes(None)) == len(D.word_hashes(" ")) == 0


def test_powers_follow_the_slice(monkeypatch):
    text = "a word " * 40
    want = list(D.word_hashes(text))
    with monkeypatch.context() as inside:
        inside.setattr(D, "SLICE", 50)
        assert list(D.word_hashes(text)) == want
        D._slice_powers.cache_clear()
        D.word_hashes(text)
    assert list(D.word_hashes(text)) == want
