from reportgrid.llm import line_dedup, quality_rules


def test_lines_of_a_site_go(spark):
    rows = [(k, "a" if k < 40 else None, f"Menu\nown {k}\n\nMenu\nshared {k % 10}") for k in range(80)]
    rows += [(100 + k, "b", "Menu\nother") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = {r.doc_id: r for r in line_dedup.drop_lines(docs, ratio=0.2).collect()}
    for k in range(80):
        assert out[k].text == f"own {k}\n\nshared {k % 10}" and out[k].lines_dropped == 2 and out[k].lines_before == 5
    assert out[100].text == "Menu\nother"  # too few pages to tell
    # four pages of forty hold each shared line: fewer than the least number
    assert all("shared" in out[k].text for k in range(80))


def test_edges_of_the_table(edge_docs, no_docs):
    rows = line_dedup.drop_lines(edge_docs, ratio=0.2, min_pages=2).collect()
    assert len(rows) == 12 and rows[0].key == "x"
    by = {r.doc_id: r for r in rows if r.doc_id}
    assert by[2].text is None and by[2].lines_before == 0
    assert by[3].text == "" and by[1].text == "" and by[1].lines_dropped == 1
    assert by[4].lines_dropped == 0 and by[6].lines_dropped == 0
    assert line_dedup.drop_lines(no_docs).count() == 0


def test_many_sites_take_the_shuffled_way(spark):
    rows = [(s * 10 + k, f"s{s}", f"head {s}\nbody {s} {k}") for s in range(300) for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = line_dedup.drop_lines(docs)
        assert out.filter("lines_dropped <> 1").count() == 0 and out.count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_python_in_the_plans(edge_docs):
    for frame in (line_dedup.drop_lines(edge_docs), quality_rules.judge(edge_docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# --- quality rules ---------------------------------------------------------------------


def slow_repeats(words):
    seen = {}
    for k in range(len(words) - 4):
        seen.setdefault(tuple(words[k : k + 5]), []).append(k)
    return len({p + j for ps in seen.values() if len(ps) > 1 for p in ps for j in range(5)})


def test_counts_against_brute_force(spark):
    import random
    import re

    rng = random.Random(8)
    texts = [None, "", " \n ", "one", "a b c d e a b c d e", "x " * 400, "#a *b $c %d\n#a *b $c %d\n\n"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts += ["\n".join(" ".join(rng.choice(["aa", "bé", "c|c", "d<d"]) for _ in range(4)) for _ in range(8)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in quality_rules.judge(docs).collect():
        text = texts[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        repeats = slow_repeats(words)
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), repeats)
        assert r.base_failed == (len(words) < 10 or 100 * repeats > 20 * len(words))
        assert not (r.base_failed and r.kept)


def test_order_of_rules_changes_no_verdict(edge_docs, no_docs):
    rows = quality_rules.measures(edge_docs)
    rules = [quality_rules.Rule("base", quality_rules.base_failed()), *quality_rules.rules()]
    sets = []
    for order in (rules, rules[::-1]):
        found = quality_rules.cascade(rows, order)
        sets.append(sorted((r.doc_id or -1, r.failed is None) for r in found.collect()))
    assert sets[0] == sets[1] and len(sets[0]) == 12
    assert quality_rules.judge(edge_docs).count() == 12
    assert quality_rules.judge(no_docs).count() == 0


def test_cheap_rules_that_reject_much_come_first(spark):
    from pyspark.sql import functions as F

    sample = spark.range(20000).select("id", F.lit("x").alias("text"))
    dear = F.col("id").cast("string")
    for _ in range(60):
        dear = F.sha2(dear, 256)
    rules = [
        quality_rules.Rule("never", F.col("id") < 0),
        quality_rules.Rule("dear", (F.col("id") % 2 == 0) & (dear != "")),
        quality_rules.Rule("cheap", F.col("id") % 2 == 1),
    ]
    assert [r.name for r in quality_rules.ordered(sample, rules)] == ["cheap", "dear", "never"]
