"""Shared folder, written intermediate tables and the two word rules."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from givingledger.sources.scratch import new_folder

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[\x20\x09-\x0D]+"
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def slices(batches: Iterable, rows: int) -> Iterator:
    """Batches (or arrays, or tuples of arrays) in stretches of at most `rows`; what a batch took is given back after it."""
    for batch in batches:
        many = isinstance(batch, tuple)
        n = len(batch[0]) if many else len(batch) if isinstance(batch, pa.Array) else batch.num_rows
        for start in range(0, max(n, 1), rows):
            yield tuple(c.slice(start, rows) for c in batch) if many else batch.slice(start, rows)
        del batch
        pa.default_memory_pool().release_unused()


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most `rows` in this session, unless it has a limit of its own. An executor holds a batch of texts outside
    its heap, up to three times while it grows, and once more in Python: 10,000 texts, Spark's default, are too many for small ones."""
    if spark.conf.get(ARROW_ROWS, None) is None:
        spark.conf.set(ARROW_ROWS, rows)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, and a lost executor costs no earlier stage."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_names(taken: list[str], *names: str) -> list[str]:
    """The names, each with underscores before it until no column of `taken` is called so, in any case."""
    used, found = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        found.append(name)
    return found


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column, separator: str) -> Column:
    """Words between separators; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separator), "")


def sha256_of(column: Column) -> Column:
    return F.sha2(F.encode(column, "UTF-8"), 256)
