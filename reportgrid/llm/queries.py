"""The registered queries of the operators for training data, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportgrid.llm import (
    alignment,
    bpe,
    decontaminate,
    html_extract,
    lexical_search,
    line_dedup,
    packing,
    quality_rules,
    simhash,
    suffix_dedup,
    toxicity,
    url_filter,
    warc,
)
from reportgrid.llm.tables import table
from reportgrid.sources.staging import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))


SQL["op10_quality_rules"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), s AS (
  SELECT r, i, md5(array_to_string(words[i : i + 4], chr(10))) AS h
  FROM w, unnest(range(1, greatest(len(words) - 3, 1))) AS u(i)
), g AS (SELECT r, h FROM s GROUP BY r, h HAVING count(*) > 1),
p AS (SELECT DISTINCT r, i + k AS pos FROM s JOIN g USING (r, h), unnest(range(0, 5)) AS u(k)),
n AS (SELECT r, count(*) AS c FROM p GROUP BY r),
m AS (
  SELECT r, doc_id, t, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
         len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(c, 0) AS n_repeat_words,
         len(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS upper_n,
         len(regexp_replace(t, '[^\p{L}]+', '', 'g')) AS letters_n,
         len(list_filter(string_split(t, chr(10)),
             lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS ended
  FROM w LEFT JOIN n USING (r)
), f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words OR 2 * upper_n > letters_n
            OR 10 * ended > 3 * n_lines) AS kept
FROM f
"""


@query
def op4_line_dedup(spark, sf_dir):
    found = line_dedup.drop_lines(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.col("lines_before").alias("n_lines"),
        F.col("lines_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


SQL["op4_line_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source,
         CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS lines
  FROM documents
), l AS (
  SELECT DISTINCT r, source, x FROM d, unnest(lines) AS u(x) WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
), n AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
b AS (
  SELECT l.source, x FROM l JOIN n ON l.source IS NOT DISTINCT FROM n.source
  GROUP BY l.source, x, pages HAVING count(*) >= 8 AND count(*) > 0.05 * pages
), e AS (
  SELECT r, i, lines[i] AS x, source FROM d, unnest(range(1, len(lines) + 1)) AS u(i)
), k AS (
  SELECT r, count(*) AS kept, string_agg(e.x, chr(10) ORDER BY i) AS t
  FROM e LEFT JOIN b ON e.source IS NOT DISTINCT FROM b.source AND e.x = b.x
  WHERE b.x IS NULL GROUP BY r
)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines,
       CAST(len(lines) - coalesce(kept, 0) AS BIGINT) AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""


@query
def op5_warc(spark, sf_dir):
    folder = new_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    found, _ = warc.recovered(spark, folder)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op5_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS n, sha1(html) AS h FROM p),
k AS (SELECT h, max(page_id) AS keeper FROM d WHERE n >= 1000 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d.h AS payload_digest,
       CASE WHEN keeper > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper > page_id THEN keeper END AS refers_to
FROM d LEFT JOIN k ON d.h = k.h AND d.n >= 1000
"""

#: Rules on host and path: fixed values of the query.
URL_RULES = [
    url_filter.Rule("allow", "com/"),
    url_filter.Rule("block", "example.com/en/"),
    url_filter.Rule("allow", "www.example.com/en/"),
    url_filter.Rule("block", "net/es/"),
    url_filter.Rule("block", "net/fr/"),
]


@query
def op6_url_filter(spark, sf_dir):
    found = url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op3_toxicity(spark, sf_dir):
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_html_extract(spark, sf_dir):
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op8_decontaminate(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def vocabulary() -> str:
    """The public byte-level vocabulary, as it is installed beside the libraries."""
    import public_tokenizers

    return Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")


@query
def op2_bpe(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary())


@query
def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op11_lexical_search(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op11_lexical_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), s AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
m AS (SELECT r, doc_id, 75 + (25 * len(terms) * n_docs) // n_terms AS m FROM d, s WHERE len(terms) > 0),
p AS (SELECT r, term, count(*) AS tf FROM d, unnest(terms) AS u(term) GROUP BY r, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM p, s GROUP BY term
), b AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark
), t AS (SELECT q, item_id, term, count(*) AS times FROM b, unnest(terms) AS u(term) GROUP BY q, item_id, term),
c AS (
  SELECT q, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM t JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY q, item_id, r, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM c WHERE score > 0 QUALIFY rank <= 20
"""


@query
def op12_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), end_id=2, capacity=1024)


@query
def op13_token_alignment(spark, sf_dir):
    import public_tokenizers

    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return alignment.align(table(spark, sf_dir, "documents"), vocabulary(), model)
