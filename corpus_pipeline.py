"""The corpus pipeline: toxic documents go, boilerplate lines go, one document of each group of near-duplicates
stays, documents with benchmark passages go, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the
columns of ``documents``; nulls, repeated rows and empty tables are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportgrid.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from reportgrid.llm.queries import vocabulary
from reportgrid.llm.tables import table
from reportgrid.sources.staging import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. The score is learnt from the labelled documents of the input that are not held out."""
    model = toxicity.fit(staged(toxicity.training_rows(docs, table(spark, sf_dir, "labels"))))
    return toxicity.add_score(docs.select(*COLUMNS), model).filter("toxicity < 0.5").select(*COLUMNS)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a source repeats on too many documents go; ``n_chars`` follows the text."""
    kept = line_dedup.drop_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.when(F.col("lines_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(
        *COLUMNS
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays, once if its row is repeated.

    Rows without id stay: nothing could name them.
    """
    docs = docs.select(*COLUMNS)
    found = staged(simhash.near_duplicates(docs).filter("doc_id IS NOT NULL"))
    keepers = found.filter("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    kept = docs.join(keepers, F.col("doc_id") == F.col("kept_id")).select(*COLUMNS)
    if found.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["doc_id"])  # only then the texts are sorted once more
    return kept.unionByName(docs.filter("doc_id IS NULL"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go; rows without id stay, as nothing could name them."""
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("leak_id")).distinct()
    return docs.select(*COLUMNS).join(staged(found), F.col("doc_id") == F.col("leak_id"), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and of the decoded text."""
    return bpe.encode_documents(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

#: Scores, fingerprints and ids cannot be expressed in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
