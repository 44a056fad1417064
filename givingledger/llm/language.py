"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of a bounded, hash-chosen sample of labelled rows. The log-probability matrix (languages x buckets) is
broadcast in blocks of at most `block` languages; texts are scored in Arrow batches with numpy, block by block, and the best of all
blocks is exact, since each gives its best total and its share of the sum. Only texts go into Python, and only results come back.
Weights are whole numbers (log probabilities in 2^-20), so that scores do not depend on batches or partitions.

Null text, and text without a letter: `und`, score 0. Ties: the smallest language name. Rows are independent, so repeated
rows get repeated results; other columns are never read, whatever their names. Without any labelled row everything is `und`, and
`accepted`, which would drop all documents then, raises.
Very long texts are scored in segments of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from givingledger.llm.common import fresh_names, slices

ORDERS = (2, 3)
SCALE = float(1 << 20)
SEGMENT = 1 << 17
UNKNOWN = "und"
ROWS = 500
BEST = "struct<spelled:boolean,lang:string,total:bigint,odds:double>"


@dataclass(frozen=True)
class LanguageModel:
    """languages in name order; weights[l, bucket] and priors[l] are log probabilities times SCALE."""

    languages: list[str]
    weights: np.ndarray
    priors: np.ndarray


def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def segments(texts: list[str | None], letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points of lower-cased segments, all but letters as blanks, with their text's place; -1 between segments."""
    points, owners, size, gap = [], [], 0, np.full(max(ORDERS) - 1, 32, dtype=np.uint32)
    for place, text in enumerate(texts):
        if not text:
            continue
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        codes = np.where(letters[codes], codes, np.uint32(32))
        for start in range(0, len(codes), SEGMENT):
            part = codes[start : start + SEGMENT + max(ORDERS) - 1]
            points += [part, gap]
            owners += [np.full(len(part), place, dtype=np.int64), np.full(len(gap), -1, dtype=np.int64)]
            size += len(part)
            if size >= 4 * SEGMENT:
                yield np.concatenate(points), np.concatenate(owners)
                points, owners, size = [], [], 0
    if points:
        yield np.concatenate(points), np.concatenate(owners)


def hashed(points: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each place."""
    n = len(points) - order + 1
    mixed = np.full(max(n, 0), order, dtype=np.uint32)
    for k in range(order):
        mixed = (mixed ^ points[k : k + n]) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
    return (mixed & np.uint32(buckets - 1)).astype(np.int64)


def grams(points: np.ndarray, owners: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(owner, bucket) of every n-gram that lies in one text and is not blank only."""
    for order in ORDERS:
        n = len(points) - order + 1
        if n <= 0:
            continue
        inside = (owners[:n] == owners[order - 1 :]) & ((points[:n] != 32) | (points[order - 1 :] != 32))
        yield owners[:n][inside], hashed(points, order, buckets)[inside]


def fit(docs: DataFrame, buckets: int = 1 << 14, rows_per_language: int = 4000, block: int = 256) -> list[LanguageModel]:
    """Learns from (doc_id, text, lang) rows with text and lang; at most about `rows_per_language` of each language.

    The sample takes the rows whose hashed id falls below a share; ids and languages alone decide. One model for each block of languages,
    in the order of their names.
    """
    rows = docs.select("doc_id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    totals = rows.groupBy("lang").count().orderBy("lang").collect()
    everything = sum(r["count"] for r in totals)
    return [fit_block(rows, totals[i : i + block], everything, buckets, rows_per_language) for i in range(0, len(totals), block)]


def fit_block(rows: DataFrame, totals: list, everything: int, buckets: int, rows_per_language: int) -> LanguageModel:
    languages = [r["lang"] for r in totals]
    place = {name: i for i, name in enumerate(languages)}
    share = F.create_map(*[F.lit(x) for r in totals for x in (r["lang"], min(1.0, rows_per_language / r["count"]))])
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, found = letter_table(), np.zeros(len(place) * buckets, dtype=np.int64)
        for batch in slices(batches, ROWS):
            classes = np.array([place[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
            for points, owners in segments(batch.column("text").to_pylist(), letters):
                for owner, bucket in grams(points, owners, buckets):
                    cells, n = np.unique(classes[owner] * buckets + bucket, return_counts=True)
                    found[cells] += n
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["cell", "n"])

    cells = chosen.select("text", "lang").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.ones(len(languages) * buckets)
    counts[cells["cell"].to_numpy(dtype=np.int64)] += cells["n"].to_numpy(dtype=float)
    counts = counts.reshape(len(languages), buckets)
    weights = np.rint(np.log(counts / counts.sum(axis=1, keepdims=True)) * SCALE).astype(np.int64)
    prior = np.array([r["count"] for r in totals], dtype=float)
    return LanguageModel(languages, weights, np.rint(np.log(prior / everything) * SCALE).astype(np.int64))


def score_texts(texts: list[str | None], model: LanguageModel, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each text whether it has a letter, the place of its best language, that total, and the sum of all languages' odds to it."""
    buckets = model.weights.shape[1]
    totals = np.zeros((len(model.languages), len(texts)), dtype=np.int64)
    spelled = np.zeros(len(texts), dtype=bool)
    for points, owners in segments(texts, letters):
        spelled[owners[points != 32]] = True
        for owner, bucket in grams(points, owners, buckets):
            if len(owner):
                starts = np.flatnonzero(np.diff(owner, prepend=-1))
                for i in range(len(model.languages)):
                    np.add.at(totals[i], owner[starts], np.add.reduceat(model.weights[i][bucket], starts))
    totals += model.priors[:, None]
    best = totals.argmax(axis=0)
    return spelled, best, totals.max(axis=0), np.exp((totals - totals.max(axis=0)) / SCALE).sum(axis=0)


def scorer(model: LanguageModel, spark: SparkSession) -> Callable[[Column], Column]:
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(BEST)
    def best_of_block(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        letters = letter_table()
        for batch in batches:
            parts = []
            for texts in slices([batch], ROWS):
                spelled, best, total, odds = score_texts(texts.to_pylist(), shared.value, letters)
                names = pa.array([shared.value.languages[b] for b in best], pa.string())
                parts.append(pa.StructArray.from_arrays([pa.array(spelled), names, pa.array(total), pa.array(odds)], names=["spelled", "lang", "total", "odds"]))
            yield pa.concat_arrays(parts)

    return best_of_block


def predict(docs: DataFrame, models: list[LanguageModel], text: str = "text", label: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with two more columns; columns of these names that docs already has are replaced."""
    kept = [c for c in docs.columns if c not in (label, score)]
    if not models:
        return docs.select(*kept, F.lit(UNKNOWN).alias(label), F.lit(0.0).alias(score))
    names = fresh_names([*docs.columns, label, score], *[f"block{i}" for i in range(len(models))], "best")
    scored = docs.withColumns({n: scorer(m, docs.sparkSession)(F.col(text).cast("string")) for n, m in zip(names, models, strict=False)})
    blocks = [F.col(n) for n in names[:-1]]
    top = F.greatest(*[b["total"] for b in blocks]) if len(blocks) > 1 else blocks[0]["total"]
    scored = scored.withColumn(names[-1], top)
    chosen = F.coalesce(*[F.when(b["total"] == F.col(names[-1]), b["lang"]) for b in blocks])
    odds = reduce(lambda a, b: a + b, [b["odds"] * F.exp((b["total"] - F.col(names[-1])) / SCALE) for b in blocks])
    spelled = blocks[0]["spelled"]
    return scored.select(*kept, F.when(spelled, chosen).otherwise(UNKNOWN).alias(label), F.when(spelled, 1.0 / odds).otherwise(0.0).alias(score))


def held_out() -> F.Column:
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0


def identify(docs: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score per document; learns from labelled documents outside the held-out fold."""
    rows = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    model = fit((docs if training is None else training).filter(~F.coalesce(held_out(), F.lit(False))))
    return predict(rows, model).drop("text")


def accepted(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The documents whose language is known with at least `min_score`; same columns."""
    models = fit(docs.filter(~F.coalesce(held_out(), F.lit(False))))
    if not models and not docs.isEmpty():
        raise ValueError("no document outside the held-out fold has a text and a language: there is no language to learn")
    label, score = fresh_names(docs.columns, "lang_pred", "score")
    found = predict(docs, models, label=label, score=score)
    return found.filter((F.col(label) != UNKNOWN) & (F.col(score) >= min_score)).drop(label, score)
