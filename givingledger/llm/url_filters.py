"""URL filters: host and path rules, and a Bloom filter cascade that holds a list of hosts exactly.

The cascade's first level is a Bloom filter of the listed keys; the keys of the corpus that it takes wrongly fill the second
level, the listed ones that this takes wrongly the third, and so on until a level takes none wrongly. Built over all keys of
the corpus, it answers for each of them exactly, without a join: a key is listed if the first level that does not hold it
has an even number (counted from 1), or, if all hold it, if their number is odd.

Bits are set per partition and combined by `bit_or`; levels are broadcast. A level of more than `MAX_BITS` bits (about
200 million keys) is refused rather than broadcast. Null url, or one without `://`: empty host and path, judged like others.
Repeated rows are judged one by one. An empty list or table gives an empty cascade that lists nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from givingledger.llm.common import lower_ascii, written
from givingledger.llm.shingles import mix

MAX_BITS = 1 << 31
# Fixed values: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
LISTED_WORDS = r"(^|[.-])(casino|poker|betting|jackpot|adult|pills)"


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    hashes: int
    words: np.ndarray

    def holds(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        at = places(one, two, self.number, self.bits, self.hashes)
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


def places(one: np.ndarray, two: np.ndarray, number: int, bits: int, hashes: int) -> np.ndarray:
    """Bit places (hash by key) of keys with the 64-bit hashes one and two, in a level."""
    first = mix(one.astype(np.int64).view(np.uint64) + np.uint64(number) * np.uint64(0x9E3779B97F4A7C15))
    step = mix(two.astype(np.int64).view(np.uint64) ^ np.uint64(number * 0x2545F491)) | np.uint64(1)
    return (first + np.arange(hashes, dtype=np.uint64)[:, None] * step) % np.uint64(bits)


def hashed(keys: DataFrame) -> DataFrame:
    return keys.select("key", F.xxhash64("key", F.lit(1)).alias("one"), F.xxhash64("key", F.lit(2)).alias("two"))


def build_level(keys: DataFrame, number: int, n: int, rate: float) -> Level:
    bits = max(64, 64 * math.ceil(n * -math.log(rate) / math.log(2) ** 2 / 64))
    if bits > MAX_BITS:
        raise ValueError(f"a level of {bits} bits is too large to broadcast")
    hashes = max(1, round(bits / n * math.log(2))) if n else 1

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(places(batch.column("one").to_numpy(), batch.column("two").to_numpy(), number, bits, hashes))
            word, starts = np.unique((at >> np.uint64(6)).astype(np.int64), return_index=True)
            ones = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), starts) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(ones.view(np.int64))], names=["word", "ones"])

    found = keys.select("one", "two").mapInArrow(set_bits, "word long, ones long").groupBy("word").agg(F.expr("bit_or(ones)").alias("ones")).toPandas()
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[found["word"].to_numpy(dtype=np.int64)] = found["ones"].to_numpy(dtype=np.int64).view(np.uint64)
    return Level(number, bits, hashes, words)


def held_by(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    @F.pandas_udf("boolean")
    def holds(one: pd.Series, two: pd.Series) -> pd.Series:
        return pd.Series(shared.value.holds(one.to_numpy(), two.to_numpy()))

    return keys.filter(holds("one", "two"))


def build_cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """The levels for listed (key) over universe (key); listed keys that the universe lacks are left out."""
    everything = hashed(universe.filter("key IS NOT NULL").distinct())
    inside = written(everything.join(listed.select("key").distinct(), "key", "left_semi"), "listed")
    outside = written(everything.join(inside.select("key"), "key", "left_anti"), "unlisted")
    levels: list[Level] = []
    n, others = inside.count(), outside.count()
    rate = min(0.5, max(1e-4, 0.7 * n / max(others, 1)))
    while n:
        level = build_level(inside, len(levels) + 1, n, rate)
        levels.append(level)
        inside, outside = written(held_by(outside, level), "held"), inside
        n, rate = inside.count(), 0.5
    return levels


def is_listed(keys: Column, levels: list[Level], frame: DataFrame) -> Column:
    shared = frame.sparkSession.sparkContext.broadcast(levels)

    @F.pandas_udf("boolean")
    def listed(one: pd.Series, two: pd.Series) -> pd.Series:
        first, second = one.to_numpy(), two.to_numpy()
        passed = np.zeros(len(first), dtype=np.int64)
        for level in shared.value:
            passed += (passed == level.number - 1) & level.holds(first, second)
        return pd.Series(passed % 2 == 1)

    return listed(F.xxhash64(keys, F.lit(1)), F.xxhash64(keys, F.lit(2)))


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_column(rules: tuple[tuple[str, str, str], ...], value: int | None) -> Column:
    """The text of the longest rule that fits host and path (value None), or its verdict (value 0); null if none fits."""
    column = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fits = ((F.col("host") == rule[1]) | F.col("host").endswith("." + rule[1])) & F.col("path").startswith(rule[2])
        column = F.when(fits, F.lit(rule[1] + rule[2] if value is None else rule[value])).otherwise(column)
    return column


def listed_hosts(pages: DataFrame) -> DataFrame:
    """(key): hosts with a listed word in their name, standing for a list that is kept elsewhere."""
    return pages.select(host_of(F.col("url")).alias("key")).distinct().filter(F.col("key").rlike(LISTED_WORDS))


def judge(pages: DataFrame, listed: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict per page: the longest rule's, else block for listed hosts and allow for others."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    levels = build_cascade(listed, rows.select(F.col("host").alias("key")))
    own = F.when(is_listed(F.col("host"), levels, rows), "block").otherwise("allow")
    ruled = rows.select("*", rule_column(rules, None).alias("rule"), rule_column(rules, 0).alias("_ruled"), own.alias("_own"))
    return ruled.select("page_id", "host", "path", "rule", F.coalesce("_ruled", "_own").alias("verdict"))


def oracle() -> str:
    """SQL for judge() with listed_hosts() and RULES."""
    case = {"rule": "", "verdict": ""}
    for verdict, host, path in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        test = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
        case["rule"] += f" WHEN {test} THEN '{host}{path}'"
        case["verdict"] += f" WHEN {test} THEN '{verdict}'"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
        WITH parts AS (
            SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{upper}', '{lower}') AS host,
                   coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages)
        SELECT page_id, host, path, CASE{case["rule"]} END AS rule,
               CASE{case["verdict"]} WHEN regexp_matches(host, '{LISTED_WORDS}') THEN 'block' ELSE 'allow' END AS verdict
        FROM parts"""
