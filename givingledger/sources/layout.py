"""The base tables laid out by donor: gifts, links and notes in buckets, so that work by donor needs no shuffle of them.

A bucket is read by one task, so a key with very many rows would make one task long. Keys with more than a quarter of a bucket's mean
number of rows, and rows without a key, are kept apart in a plain table; there are at most ``4 * buckets`` such keys. Work by donor is
done on both parts, which share no donor.

The number of buckets follows the data, so that the share of one task, and with it its memory, stays as it is while tables grow.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from givingledger.functions.ids import GUID
from givingledger.sources.tables import SCHEMAS, DonorTables

BY_KEY = {"donations": "DonorProfileID", "donor_links": "DonorProfileID", "notes": "ParentID"}
FREQUENT = "_frequent"
ABOUT = "_layout"
LEAST_BUCKETS = 8
ROWS_IN_BUCKET = 250_000  # a task that makes labels of so many gifts takes about half a GB
TEXT_IN_BUCKET = 256 << 20  # bytes


def is_id(name: str) -> bool:
    return name.endswith("ID") or name == "CreatedBy"


def _text_ids(table: DataFrame) -> list[str]:
    return [f.name for f in table.schema if is_id(f.name) and f.name != "ParentSystemClassID" and isinstance(f.dataType, StringType)]


def all_guids(table: DataFrame) -> bool:
    """Whether all known ids are GUID text in its usual form."""
    kinds = [f for f in table.schema if is_id(f.name) and f.name != "ParentSystemClassID"]
    if len(_text_ids(table)) < len(kinds):
        return False
    others: list[Column] = [F.count(F.when(~F.regexp_like(c, F.lit(GUID)), 1)).alias(c) for c in _text_ids(table)]
    return not any(table.agg(*others).first())


def frequent_keys(table: DataFrame, key: str, buckets: int) -> DataFrame:
    """At most ``4 * buckets`` keys, those that hold more rows than a quarter of a bucket's share."""
    counts = table.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("Rows"))
    total = table.agg(F.count(F.lit(1)).alias("Total"))
    return counts.join(F.broadcast(total)).filter(f"Rows * {4 * buckets} > Total AND Rows > 1").select(key)  # one row


def buckets_for(tables: DonorTables) -> int:
    """As many buckets as the tables by donor need for ``ROWS_IN_BUCKET`` rows and ``TEXT_IN_BUCKET`` bytes of text in each, on average."""
    needed = [LEAST_BUCKETS]
    for name in BY_KEY:
        table = getattr(tables, name)
        texts = [F.coalesce(F.octet_length(f.name), F.lit(0)).cast("long") for f in table.schema if isinstance(f.dataType, StringType)]
        rows, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(reduce(add, texts, F.lit(0).cast("long"))), F.lit(0))).first()
        needed += [-(-rows // ROWS_IN_BUCKET), -(-size // TEXT_IN_BUCKET)]
    return max(needed)


def lay_out_tables(
    tables: DonorTables, spark: SparkSession, root: str, prefix: str, buckets: int | None = None
) -> DonorTables:
    """Writes all base tables below ``root`` and reads them from there.

    Tables by donor get ``buckets`` files, one for each bucket; by default as many as :func:`buckets_for` finds. Spark keeps
    their description in its catalog, as ``prefix`` and the table's name; the files can be registered anew in another session by
    :func:`read_layout`.
    """
    buckets = buckets_for(tables) if buckets is None else buckets
    guids, skewed = True, []
    for name in SCHEMAS:
        table, key = getattr(tables, name), BY_KEY.get(name)
        guids = guids and all_guids(table)
        if key is None:
            table.write.parquet(f"{root}/{name}")
            continue
        frequent_path = f"{root}/{name}_keys"
        frequent_keys(table, key, buckets).write.parquet(frequent_path)
        stored_keys = spark.read.parquet(frequent_path)
        skewed += [] if stored_keys.isEmpty() else [name]
        keys = F.broadcast(stored_keys)  # at most 4 * buckets rows
        usual = table.filter(F.col(key).isNotNull()).join(keys, key, "left_anti").select(*table.columns)
        frequent = table.join(keys.withColumnRenamed(key, "Frequent"), F.col(key) == F.col("Frequent"), "left")
        frequent = frequent.filter(F.col("Frequent").isNotNull() | F.col(key).isNull()).select(*table.columns)
        frequent.write.parquet(f"{root}/{name}{FREQUENT}")
        (
            usual.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
            .option("path", f"{root}/{name}").saveAsTable(f"{prefix}{name}")
        )
    about = spark.range(1).select(F.lit(buckets).alias("Buckets"), F.lit(guids).alias("Guids"), F.lit(",".join(skewed)).alias("Skewed"))
    about.write.parquet(f"{root}/{ABOUT}")
    return read_layout(spark, root, prefix)


def read_layout(spark: SparkSession, root: str, prefix: str) -> DonorTables:
    """The tables that :func:`lay_out_tables` wrote. Registers those by donor where the catalog does not have them."""
    about = spark.read.parquet(f"{root}/{ABOUT}").first()

    def stored(name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/{name}")

    def by_key(name: str) -> DataFrame:
        if not spark.catalog.tableExists(f"{prefix}{name}"):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored(f"{name}{FREQUENT}").schema)
            spark.sql(
                f"CREATE TABLE {prefix}{name} ({columns}) USING parquet CLUSTERED BY ({BY_KEY[name]}) "
                f"SORTED BY ({BY_KEY[name]}) INTO {about['Buckets']} BUCKETS LOCATION '{root}/{name}'"
            )
        return spark.table(f"{prefix}{name}")

    def parts(name: str) -> list[DataFrame]:
        """Rows without a key count for no donor; without frequent keys the buckets have all others."""
        if name not in BY_KEY:
            return [stored(name)]
        return [by_key(name), *([stored(f"{name}{FREQUENT}")] if name in about["Skewed"].split(",") else [])]

    def load(name: str) -> DataFrame:
        return by_key(name).unionByName(stored(f"{name}{FREQUENT}")) if name in BY_KEY else stored(name)

    return DonorTables(load, about["Guids"], parts)
