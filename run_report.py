"""spark-submit entry: grid rows in, fact table and quality artefacts out."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import SparkSession

from reportgrid.config import ReportConfig
from reportgrid.plans.report import run_report
from reportgrid.sinks.writers import OutputPaths, write_outputs
from reportgrid.sources.grid import page_config, read_cells, read_extents, read_rows, rows_from_cells


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--rows", help="rows table: doc_id, page_num, row_idx, cells, run_id, timestamp_utc")
    args.add_argument("--cells", help="cells table, in place of --rows")
    args.add_argument("--extents", help="width and height of each page as read, beside --cells")
    args.add_argument("--pages", required=True, help="JSON file mapping page to column count")
    args.add_argument("--config", help="JSON settings; December defaults when absent")
    args.add_argument("--format", default="parquet", choices=["parquet", "csv", "json", "orc"])
    args.add_argument("--table", help="name of the fact table")
    args.add_argument("--output-dir", help="folder for the fact file and the artefacts")
    args.add_argument("--tag", default="run")
    args.add_argument("--no-write", action="store_true")
    given = args.parse_args()
    if bool(given.rows) == bool(given.cells):
        args.error("give either --rows or --cells")
    if given.rows and given.format == "csv":
        args.error("CSV holds no lists: give the rows as parquet, json or orc, or give --cells")
    if not (given.no_write or given.output_dir or given.table):
        args.error("give --output-dir or --table, or --no-write to see the run report alone")

    spark = SparkSession.builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    raw_pages = json.loads(Path(given.pages).read_text(encoding="utf-8"))
    pages = {int(p): int(n) for p, n in raw_pages.get("page_config", raw_pages).items()}
    if given.rows:
        rows = read_rows(spark, given.rows, given.format)
    else:
        cells = read_cells(spark, given.cells, given.format)
        extents = read_extents(spark, given.extents, given.format) if given.extents else None
        rows = rows_from_cells(cells, page_config(spark, pages), ("run_id", "timestamp_utc"), extents)
    config = ReportConfig.from_json(given.config) if given.config else ReportConfig()
    result = run_report(spark, rows, pages, config)
    if given.no_write:
        result.report().show()
    elif given.output_dir:
        write_outputs(result, OutputPaths.in_folder(given.output_dir, given.tag, table=given.table))
    else:
        write_outputs(result, OutputPaths(table=given.table))
    result.release()


if __name__ == "__main__":
    main()
