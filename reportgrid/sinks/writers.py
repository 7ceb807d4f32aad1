"""Sinks: managed table, files by suffix, packed quarantine with its manifest, run report of what was written."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reportgrid.plans.report import ReportResult
from reportgrid.sources.staging import staged


def write_table(df: DataFrame, table: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Managed table; for Delta an overwrite also replaces the schema."""
    writer = df.write.format(fmt).mode(mode)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.saveAsTable(table)


#: The column that a table of documents is partitioned by.
SHARE = "doc_share"


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Inside, an overwrite swaps the partitions it has rows for; ``insertInto`` takes this from the session alone."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Rows of a share that one task writes.
TASK_ROWS = 500_000


def _dealt(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """A staged frame dealt by share, and inside large shares by all of a row, so that tasks grow in number and not in size."""
    sizes = df.groupBy(SHARE).agg(F.count(F.lit(1)).alias("n"))
    size = sizes.agg(F.count(F.lit(1)).alias("shares"), F.max("n").alias("most")).first()
    pieces = -(-(size["most"] or 0) // task_rows)
    if pieces <= 1:
        return df.repartition(SHARE)
    hashed = [c.name for c in df.schema.fields if "map<" not in c.dataType.simpleString()]
    return df.repartition(size["shares"] * pieces, SHARE, F.pmod(F.xxhash64(*hashed), F.lit(pieces)))


def replace_documents(df: DataFrame, table: str, key: str = "doc_id", shares: int = 64) -> None:
    """Writes the facts of the documents in ``df`` into a managed table, in place of those it holds of them.

    Documents are dealt to ``shares`` partitions by their hash. Everything that can fail is done beside the table: the new rows,
    and the kept rows of the partitions they fall in, are written to the shared folder first. Then these partitions alone are
    swapped by a dynamic overwrite, which moves finished files at its commit. A run that fails leaves the old facts.

    A share of many rows is written by several tasks, about one for :data:`TASK_ROWS`: each task sorts what it writes.
    """
    spark = df.sparkSession
    share = F.pmod(F.xxhash64(key), F.lit(shares)).cast("int")
    after = staged(df.withColumn(SHARE, share))
    if spark.catalog.tableExists(table):
        written = after.select(key, SHARE).distinct()
        held = spark.table(table).join(written.select(SHARE).distinct(), SHARE, "left_semi")
        kept = held.join(written.select(key), held[key].eqNullSafe(written[key]), "left_anti")
        whole = after.unionByName(kept, allowMissingColumns=True).select(*spark.table(table).columns)
        with _dynamic_overwrite(spark):
            _dealt(staged(whole)).write.mode("overwrite").insertInto(table)
    else:
        _dealt(after).write.partitionBy(SHARE).saveAsTable(table)


def flat_arrays(df: DataFrame) -> DataFrame:
    """Lists as text, for formats that hold no lists."""
    lists = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    return df.withColumns({c: F.array_join(c, "|") for c in lists})


def write_file(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Writes by suffix: parquet, JSON lines or CSV; Excel falls back to CSV. Returns the path."""
    suffix = PurePosixPath(path).suffix.lower()
    if suffix == ".parquet":
        df.write.mode(mode).parquet(path)
    elif suffix == ".json":
        df.write.mode(mode).json(path)
    else:
        if suffix in (".xlsx", ".xls"):
            path = path[: -len(suffix)] + ".csv"
            warnings.warn(f"no Excel writer here, writing {path}", stacklevel=2)
        flat_arrays(df).write.mode(mode).option("header", True).csv(path)
    return path


#: Bytes of cells in a file of the quarantine.
FILE_BYTES = 128 << 20
CELL = "doc_id bigint, page_num int, part_idx int, row_idx int, col_idx int, name string, value string"
MANIFEST = "doc_id bigint, page_num int, part_idx int, file string, first_row int, last_row int, n_cells bigint"
PART = ["doc_id", "page_num", "part_idx"]


def write_quarantine(rows: DataFrame, path: str, mode: str = "overwrite", file_bytes: int = FILE_BYTES) -> str:
    """The named cells of problem parts in long form, packed in order; returns the folder.

    ``cells`` holds them as CSV files of about ``file_bytes``, range-partitioned by part and row, so that how many files there
    are follows from the bytes and a part lies in neighbouring files. ``manifest`` lists the parts of each file with their rows
    and number of cells, counted from the files as they were written.
    """
    suffix = PurePosixPath(path).suffix
    folder = path[: -len(suffix)] if suffix else path
    cells = staged(
        rows.select(
            "doc_id",
            "page_num",
            F.col("idx").alias("part_idx"),
            "row_idx",
            F.posexplode(
                F.arrays_zip(
                    F.col("names").alias("name"),
                    F.slice(F.col("cells"), F.col("lo") + 1, F.col("width")).alias("value"),
                )
            ).alias("col_idx", "cell"),
        ).select(*PART, "row_idx", "col_idx", "cell.name", "cell.value")
    )
    # the numbers of a cell take some twenty signs in a line
    line = 20 + F.coalesce(F.octet_length("name"), F.lit(0)) + F.coalesce(F.octet_length("value"), F.lit(0))
    size = cells.agg(F.sum(line)).first()[0] or 0
    order = [*PART, "row_idx", "col_idx"]
    packed = cells.repartitionByRange(int(size // file_bytes) + 1, *order).sortWithinPartitions(*order)
    packed.write.mode(mode).option("header", True).csv(f"{folder}/cells")
    # the file's own name alone: the folder can be moved
    file = F.regexp_extract(F.input_file_name(), "[^/]+$", 0).alias("file")
    listed = _cells(rows.sparkSession, folder).groupBy(*PART, file).agg(
        F.min("row_idx").alias("first_row"), F.max("row_idx").alias("last_row"), F.count(F.lit(1)).alias("n_cells")
    )
    listed.write.mode(mode).parquet(f"{folder}/manifest")
    return folder


def _cells(spark: SparkSession, folder: str, files: Sequence[str] = ("",)) -> DataFrame:
    return spark.read.schema(CELL).option("header", True).csv([f"{folder}/cells/{file}".rstrip("/") for file in files])


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A record for each file and part it holds: ``doc_id, page_num, part_idx, file, first_row, last_row, n_cells``."""
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_quarantine(spark: SparkSession, folder: str, where: Column | None = None) -> DataFrame:
    """The cells of a packed quarantine, of those parts that ``where`` picks by the columns of the manifest.

    Only the files that hold some of these parts are read; their names, at most all of the quarantine's, are looked up first.
    """
    if where is None:
        return _cells(spark, folder)
    picked = read_manifest(spark, folder).filter(where)
    files = sorted(r["file"] for r in picked.select("file").distinct().collect())
    if not files:
        return spark.createDataFrame([], CELL)
    return _cells(spark, folder, files).join(picked.select(*PART).distinct(), PART, "left_semi")


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The one-record run report as JSON."""
    report.coalesce(1).write.mode(mode).json(path)


class Counted:
    """Rows of frames as they are written, counted on their way to the sink."""

    def __init__(self) -> None:
        self.seen: dict[str, Observation] = {}

    def rows(self, name: str, df: DataFrame) -> DataFrame:
        self.seen[name] = Observation(name)
        return df.observe(self.seen[name], F.count(F.lit(1)).alias("n"))

    def counts(self) -> dict[str, int]:
        """Rows by output; to be asked for when all are written."""
        return {name: seen.get["n"] for name, seen in self.seen.items()}


@dataclass(frozen=True)
class OutputPaths:
    """Where the results go; a path that is None is not written."""

    table: str | None = None
    facts: str | None = None
    qc_summary: str | None = None
    errors: str | None = None
    quarantine: str | None = None
    lost_values: str | None = None
    run_report: str | None = None
    table_format: str = "parquet"
    write_mode: str = "overwrite"

    @classmethod
    def in_folder(cls, folder: str, tag: str, **changes) -> OutputPaths:
        """All files of a run below one folder, marked with the tag of its settings."""
        names = {
            "facts": f"df_final_{tag}.csv",
            "qc_summary": f"qc_summary_{tag}.csv",
            "errors": f"errors_{tag}.csv",
            "quarantine": f"df_to_analyze_{tag}",
            "lost_values": f"log_percentage_{tag}.csv",
            "run_report": f"run_report_{tag}.json",
        }
        return cls(**{**{k: f"{folder.rstrip('/')}/{v}" for k, v in names.items()}, **changes})


#: The forecast of the run report that an output's rows are held against.
FORECAST = {"table": "facts_rows", "facts": "facts_rows", "qc_summary": "qc_summary_rows", "errors": "errors_rows"}
OUTPUTS = "array<struct<output:string,forecast:bigint,written:bigint,agrees:boolean>>"


def write_outputs(result: ReportResult, paths: OutputPaths) -> dict[str, int]:
    """Writes what has a path; returns the rows of each output (for the quarantine its parts) as the sinks got them.

    The run report holds the forecast from the parts, and in ``outputs`` a record for each output that was written: what
    was forecast, what was written, and whether both agree.
    """
    counted = Counted()
    if paths.table:
        write_table(counted.rows("table", result.facts), paths.table, paths.table_format, paths.write_mode)
    for name in ("facts", "qc_summary", "errors", "lost_values"):
        path = getattr(paths, name)
        if path:
            write_file(counted.rows(name, getattr(result, name)), path)
    written = counted.counts()
    spark = result.rows.sparkSession
    if paths.quarantine:
        folder = write_quarantine(result.quarantine, paths.quarantine)
        written["quarantine"] = read_manifest(spark, folder).select(*PART).distinct().count()
    if paths.run_report:
        forecast = result.report()
        said = forecast.first().asDict()
        expected = {name: said[FORECAST[name]] for name in written if name in FORECAST}
        if "quarantine" in written:  # parts without a row have no cells
            expected["quarantine"] = result.parts.filter("emitted AND is_problem AND n_data > 0").count()
        outputs = [(name, e, n, None if e is None else e == n) for name, n in written.items() for e in [expected.get(name)]]
        shape = StructType([*forecast.schema.fields, *StructType.fromDDL(f"outputs {OUTPUTS}").fields])
        write_report(spark.createDataFrame([(*said.values(), outputs)], shape), paths.run_report)
    return written
