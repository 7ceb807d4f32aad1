import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from reportgrid.llm import alignment, word_encoding
from reportgrid.llm.queries import vocabulary

MODEL = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
LETTERS = ["a", "b", " ", " ", "  ", "\n", "é", "ß", "東", "<|endoftext|>", "▁", "'s", "12", "\xa0", "</s>", "the ", " of", "😀", "привет", "ﬁ", "\0", "²", "\x85"]


def mixed(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_str(vocabulary())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_proto=MODEL)


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(word_encoding.ByteLevel(vocabulary(), plain=True), word_encoding.Pieces(MODEL))


def brute(texts, libraries, aligner):
    """Groups by the set of all common ends, counts by a dictionary."""
    read, counts = [], Counter()
    for text in texts:
        a, b = libraries[0].encode(" " + (text or ""), add_special_tokens=False).ids, libraries[1].encode(text or "")
        sides = []
        for ids, letters in ((a, aligner.a.bytes_of), (b, aligner.b.bytes_of)):
            parts = [letters[n] for n in ids]
            sides.append((b"".join(parts), np.cumsum([len(p) for p in parts]).tolist()))
        if not text or any(joined != b" " + text.encode() for joined, _ in sides):
            read.append(None)
            continue
        ends = [dict(zip(e, range(len(e)))) for _, e in sides]
        common = sorted(ends[0].keys() & ends[1].keys())
        links = [(a[ends[0][c]], b[ends[1][c]]) for c in common]
        groups, at = [], (0, 0)
        for c in common:
            to = ends[0][c] + 1, ends[1][c] + 1
            groups.append(",".join(map(str, a[at[0] : to[0]])) + "|" + ",".join(map(str, b[at[1] : to[1]])))
            at = to
        counts.update(links)
        read.append((len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for one in read:
        if one is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, digest = one
        best = sum(counts[link] == most[link[1]] for link in links)
        out.append((n_a, n_b, len(links), len(links), best, sum(counts[link] for link in links), digest))
    return out


@pytest.mark.parametrize("steps", [1, 2, 16])
def test_cuts(aligner, libraries, monkeypatch, steps):
    monkeypatch.setattr(alignment, "STEPS", steps)
    texts = [*mixed(300), "x" * 9000 + "y", "東京" * 2000, "", None, "one two  three\n", " lead"]
    got = [r[:4] for r in aligner.align(texts)]
    assert got == [(w[0], w[1], w[2], w[6]) for w in brute(texts, libraries, aligner)]
    assert any(r[0] for r in got) and not all(r[0] for r in got)


@pytest.mark.parametrize("most", [600_000, 30])
def test_both_encoders_give_the_libraries_ids(libraries, monkeypatch, most):
    monkeypatch.setattr(word_encoding, "MOST_WORDS", most)
    plain, special = word_encoding.ByteLevel(vocabulary(), plain=True), word_encoding.ByteLevel(vocabulary())
    pieces, whole = word_encoding.Pieces(MODEL), Tokenizer.from_str(vocabulary())
    by = alignment.Aligner(plain, pieces)
    rng = random.Random(2)
    words = ["word", "the", "don't", "a.b,", "x\ny", "Ünï", "[12]", "zero\x00", "naïve-", "(" * 9]
    texts = [*mixed(400, 7), *(" ".join(rng.choices(words, k=30)) for _ in range(50))]
    assert sum(word_encoding.regular(t.encode()) for t in texts) > 50
    for text, both in zip(texts, by.tokens(texts)):
        assert special.encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids
        a, b = libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text)
        assert plain.encode_after_space(text).tolist() == a
        assert both is None or [x.tolist() for x in both] == [a, b]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("frequent", [1 << 16, 20, 1])
def test_counts_come_back(spark, libraries, aligner, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    texts = [*mixed(60, 3), *["the cat of the house " * 20 + str(k) for k in range(20)], "the cat", "the cat"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in alignment.align(docs, vocabulary(), MODEL).select(COLUMNS).collect())
    assert got == [(k, *row) for k, row in enumerate(brute(texts, libraries, aligner))]


def test_edges(spark, edge_docs, no_docs, libraries, aligner):
    rows = edge_docs.select("doc_id", "text").collect()
    got = alignment.align(edge_docs, vocabulary(), MODEL)
    assert got.columns == COLUMNS
    want = zip([r["doc_id"] for r in rows], brute([r["text"] for r in rows], libraries, aligner))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(str((i, *w)) for i, w in want)
    assert alignment.align(no_docs, vocabulary(), MODEL).collect() == []
