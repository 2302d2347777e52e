"""Shared pieces of the corpus operators: stored tables, Arrow batches, state of Python workers."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from millrace.session import Files, scratch_folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again.

    This computes it once, cuts its lineage, and what is read afterwards survives any executor.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more: what was made of them has to be stored itself."""
    for table in tables:
        Files(table.sparkSession, table._stored_at).remove(table._stored_at)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def worker_memo(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` built in this Python worker the first time; workers live through many tasks.

    The package is pickled by value, so its own globals are new in every task.
    """
    place = sys.modules.setdefault("millrace_worker_state", types.ModuleType("millrace_worker_state"))
    memo = place.__dict__.setdefault("memo", {})
    if key not in memo:
        memo[key] = make()
    return memo[key]


def slices(batches: Iterable[pa.RecordBatch], text: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a piece hold about ``most_bytes``, or one longer text."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pa.compute.binary_length(column).fill_null(0).to_pylist()
        begin = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most_bytes:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size
        if begin < len(sizes):
            yield batch.slice(begin)
