"""Each stage of the pipeline against a plain version of it, on its own input."""

import hashlib
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from reportgrid.llm import decontaminate, line_dedup, toxicity
from reportgrid.llm.queries import vocabulary
from test_simhash import slow_components, slow_fingerprint


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """What goes into each stage and what comes out."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in P.STAGES:
        after = P.staged(stage(spark, docs, sf_dir))
        out.append((docs, after))
        docs = after
    return out


def test_columns(steps):
    for _, after in steps[:-1]:
        assert after.columns == P.COLUMNS


def test_toxic_documents_go(spark, sf_dir, steps):
    before, after = steps[0]
    model = toxicity.fit(toxicity.training_rows(before, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    want = {i for i, r in rows(before).items() if model.score(model.passages(r.text)[1]) < 0.5}
    assert rows(after).keys() == want
    assert all(rows(after)[i] == rows(before)[i] for i in want)


def test_lines(steps):
    before, after = (rows(x) for x in steps[1])
    pages, held = Counter(), Counter()
    for r in before.values():
        pages[r.source] += 1
        held.update((r.source, x) for x in {x for x in (r.text or "").split("\n") if x.split()})
    out = {k for k, n in held.items() if n >= line_dedup.MIN_PAGES and n > line_dedup.RATIO * pages[k[0]]}
    assert before.keys() == after.keys()
    for i, r in before.items():
        text = "\n".join(x for x in r.text.split("\n") if (r.source, x) not in out)
        assert after[i].text == text and after[i].n_chars == (r.n_chars if text == r.text else len(text))


def test_one_of_each_group(steps):
    before, after = (rows(x) for x in steps[2])
    fps = {i: slow_fingerprint(r.text) for i, r in before.items()}
    root = slow_components(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert after.keys() == set(root.values())


def test_contaminated_documents_go(spark, sf_dir, steps):
    before, after = (rows(x) for x in steps[3])
    items = [decontaminate.WORD.findall((r.text or "").lower()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = set()
    for i, r in before.items():
        text = decontaminate.WORD.findall((r.text or "").lower())
        if all(decontaminate.edits(x, text)[0] > int(decontaminate.MAX_EDITS * len(x)) for x in items):
            clean.add(i)
    assert after.keys() == clean


def test_encoded(steps):
    before, after = (rows(x) for x in steps[4])
    whole = Tokenizer.from_str(vocabulary())
    assert before.keys() == after.keys()
    for i, r in before.items():
        ids = whole.encode(r.text, add_special_tokens=False).ids
        assert after[i].n_tokens == len(ids)
        assert after[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert after[i].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_edges_of_the_table(spark, sf_dir, edge_docs, no_docs):
    for given, left in ((edge_docs, True), (no_docs, False)):
        docs = given
        for _, stage in P.STAGES:
            docs = P.staged(stage(spark, docs, sf_dir))
        assert bool(docs.count()) == left
    kept = [r.doc_id for r in P.drop_near_duplicates(spark, edge_docs, sf_dir).collect()]
    assert sorted(i for i in kept if i) == [1, 2, 4, 7, 8, 9] and kept.count(None) == 2
