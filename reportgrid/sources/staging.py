"""Cutting lineage and laying rows out so that later stages need no shuffle."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator, Sequence
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_MADE: ContextVar[list[str] | None] = ContextVar("folders made in this run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, with a part of its own for this application.

    It is the one the session names in ``spark.checkpoint.dir``. Where that is unset, a folder beside the tables of the
    warehouse serves a session on one machine; on a cluster that is an error, as the warehouse may lie with the driver.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = named or spark.conf.get("spark.sql.warehouse.dir") + "/_staged"
    return f"{base.rstrip('/')}/reportgrid-{spark.sparkContext.applicationId}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, wherever it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_ENDING: set[str] = set()


def _drop_at_exit(spark: SparkSession) -> None:
    folder = shared_folder(spark)
    if folder not in _ENDING:
        _ENDING.add(folder)

        def drop() -> None:
            with contextlib.suppress(Exception):  # the session may be gone already
                remove(spark, folder)

        atexit.register(drop)


def new_folder(spark: SparkSession, name: str = "part") -> str:
    """A path of its own in the shared folder; the whole folder goes when the program ends."""
    _drop_at_exit(spark)
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return path


@contextlib.contextmanager
def folders_made() -> Iterator[list[str]]:
    """Gathers the folders that are made inside, so that a run can give them back."""
    made: list[str] = []
    before = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(before)


def staged(df: DataFrame) -> DataFrame:
    """Writes a frame to the shared folder as columns and goes on from there.

    Lineage is cut, a lost executor costs nothing, and later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle of the session has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def staged_by(df: DataFrame, keys: Sequence[str], sort: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Like :func:`staged`, laid out by the hash of ``keys``: grouping, joins and windows along them need no exchange.

    The frame should come dealt by the same keys to as many partitions, else each task writes a file for each bucket. The
    name that the catalog needs for a moment is dropped at once; the files stay until the program ends.
    """
    spark = df.sparkSession
    name = f"staged_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("path", new_folder(spark)).option("compression", "zstd")
    writer.bucketBy(buckets or partitions(spark), *keys).sortBy(*keys, *sort).saveAsTable(name)
    laid_out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return laid_out
