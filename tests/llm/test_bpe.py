import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from reportgrid.llm import bpe
from reportgrid.llm.queries import vocabulary

SAMPLES = [
    "",
    "one",
    "It's we'll   spaces\t\ttabs \n\n lines  ",
    "<|endoftext|>x<|endof text|> <|endoftext|>",
    "Ünïcode ß 東京 🙂🙂 привет    mixed　",
    "a" * 5000,
    "ab12cd 34,56 !!??" * 300,
    " " * 3000 + "x" + "\n" * 1500,
    "zero " * 4000,
]


@pytest.fixture(scope="module")
def words():
    return vocabulary()


def digest(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.mark.parametrize("bits", [2, 5, 10])
def test_joins_are_repaired(monkeypatch, words, bits):
    """Chunks of any size, encoded alone and joined, give the ids of the whole text."""
    monkeypatch.setattr(bpe, "CUT_BITS", bits)
    monkeypatch.setattr(bpe, "LEAST_BYTES", 1 << bits)
    by, whole = bpe.Encoder(words), Tokenizer.from_str(words)
    rng = random.Random(3)
    letters = "abcdefgh ÄÖ ß,.\n'  12é東 <|endoftext|>"
    mixed = ["".join(rng.choice(letters) for _ in range(2000)) for _ in range(20)]
    for text in [*SAMPLES, *mixed]:
        data = text.encode()
        places = bpe.cuts(data)
        parts = [by.encode(data[a:b]) for a, b in zip(places, places[1:])]
        got = bpe.repaired(data, places, parts, by).tolist()
        assert got == whole.encode(text, add_special_tokens=False).ids


def test_equal_passages_get_equal_chunks():
    rng = random.Random(1)
    passage = bytes(rng.randrange(97, 123) for _ in range(20000))
    a, b = b"x" * 300 + passage, b"yy" * 777 + passage
    of = [{d[i:j] for i, j in zip(c, c[1:])} for d in (a, b) for c in [bpe.cuts(d)]]
    assert len(of[0] & of[1]) >= len(of[0]) - 4


def test_table(spark, sf_dir, words):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = Tokenizer.from_str(words)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in bpe.encode_documents(docs, words, with_ids=True).collect():
        ids = whole.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == digest(",".join(map(str, ids)))
        assert r.decoded_sha256 == digest(whole.decode(ids, skip_special_tokens=False))
        assert bpe.decode(r.ids, words) == texts[r.doc_id]


def test_edges_of_the_table(edge_docs, no_docs, words):
    rows = bpe.encode_documents(edge_docs, words).collect()
    assert len(rows) == 12
    whole = Tokenizer.from_str(words)
    texts = {(r.doc_id, r.text or "") for r in edge_docs.collect()}
    want = sorted(
        (i or -1, len(ids), digest(",".join(map(str, ids))), digest(t))
        for i, t in texts
        for ids in [whole.encode(t, add_special_tokens=False).ids]
    )
    got = sorted({(r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows})
    assert got == want
    assert bpe.encode_documents(no_docs, words).count() == 0


def test_fast_library_agrees_on_latin_letters(words):
    by, whole = bpe.Encoder(words), Tokenizer.from_str(words)
    rng = np.random.default_rng(2)
    for _ in range(200):
        text = "".join(chr(int(c)) for c in rng.integers(0, 0x250, 200))
        assert by.fast.encode_ordinary(text) == whole.encode(text, add_special_tokens=False).ids
