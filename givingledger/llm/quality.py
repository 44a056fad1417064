"""Quality rules: hashed n-gram log-likelihood ratio between trusted and raw text, with fixed base rules.

Words and neighbouring word pairs are hashed into `buckets`; two multinomials are counted over them: one over all documents,
one over trusted documents (at most `max_trusted` labelled ones, chosen by hashed id). A document's score is the mean over its
n-grams of log(p_trusted / p_raw); it is kept if the base rules pass and the score reaches `threshold`. The bucket weights
have a fixed size and enter the scoring pass as a constant, so every pass over the texts is one scan without a shuffle of
text. DataFrame functions only.

Null and empty text: zero counts, score 0, fails the base rules (fewer than 20 words). Repeated rows and rows with equal ids
are judged one by one. Without trusted rows every weight is 0, so the base rules alone decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from givingledger.llm.common import SPACE, split_words

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"


def with_hashes(docs: DataFrame) -> DataFrame:
    """docs with the hashes of its words and, by doubling, of the runs of 2 and 8 words that start at each word.

    Near the end of a text a run's hash stands for fewer words; readers use only the places where a whole run fits.
    """
    worded = docs.withColumn("_words", split_words(F.col("text"), SPACE))
    hashed = worded.select(*docs.columns, F.transform("_words", lambda w: F.xxhash64(w)).alias("_h1"))
    for size in (1, 2, 4):
        joined = f"transform(_h{size}, (h, i) -> xxhash64(h, get(_h{size}, i + {size})))"
        hashed = hashed.withColumn(f"_h{2 * size}", F.expr(joined))
    return hashed


def repeated_words() -> Column:
    """Words that lie in a run of 8 words which the text holds twice or more.

    Runs are compared by 64-bit hash. Texts without a repeated run, the most, are told by the number of distinct hashes;
    for the others, runs are sorted by hash, those with an equal neighbour are put in order, and their words counted once.
    """
    return F.expr(f"""
        CASE WHEN size(_h8) <= {WINDOW} THEN 0L
        WHEN size(array_distinct(_runs)) = size(_runs) THEN 0L ELSE aggregate(
            array(sort_array(transform(_runs, (h, i) -> struct(h AS h, i AS i)))), 0L,
            (acc2, s) -> aggregate(
                array(sort_array(transform(filter(s, (x, k) ->
                    coalesce(get(s, k - 1).h = x.h, false) OR coalesce(get(s, k + 1).h = x.h, false)), x -> x.i))), 0L,
                (acc3, p) -> aggregate(transform(p, (i, k) -> least({WINDOW}, coalesce(get(p, k + 1) - i, {WINDOW}))), 0L,
                    (a, x) -> a + x))) END""")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, text and the counts of the base rules, from whole texts."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.withColumn("_runs", F.slice("_h8", 1, F.greatest(F.size("_h8") - (WINDOW - 1), F.lit(0))))
    return rows.select(
        "*",
        F.size("_h1").cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words().alias("n_repeat_words"),
    )


def grams() -> Column:
    """Hashes of all words, then of all neighbouring pairs."""
    return F.concat("_h1", F.slice("_h2", 1, F.greatest(F.size("_h2") - 1, F.lit(0))))


def bucket_weights(docs: DataFrame, labels: DataFrame, buckets: int, max_trusted: int, smoothing: float) -> DataFrame:
    """One row: the weight of every bucket as an array, at place bucket."""
    trusted = (
        labels.filter("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_trusted).select(F.col("doc_id").alias("_id"), F.lit(1).alias("_trusted"))
    )
    rows = docs.join(F.broadcast(trusted), F.col("doc_id") == F.col("_id"), "left")
    counted = (
        rows.select("_trusted", F.explode(grams()).alias("_gram"))
        .groupBy(F.pmod("_gram", F.lit(buckets)).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("raw"), F.count("_trusted").alias("trusted"))
    )
    cells = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = cells.join(counted, "bucket", "left").select(
        "bucket", *[(F.coalesce(c, F.lit(0)) + F.lit(smoothing)).alias(c) for c in ("raw", "trusted")])
    ordered = both.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "trusted"))).alias("cells"),
        F.sum("raw").alias("raws"), F.sum("trusted").alias("trusteds"))
    return ordered.select(F.expr(f"""CASE WHEN trusteds <= {buckets} * {smoothing}D THEN transform(cells, c -> 0D)
        ELSE transform(cells, c -> ln(c.trusted / trusteds) - ln(c.raw / raws)) END""").alias("weights"))


def judge(docs: DataFrame, labels: DataFrame, buckets: int = 1 << 14, max_trusted: int = 20000, smoothing: float = 1.0,
          threshold: float = -0.08) -> DataFrame:
    """doc_id, the base counts, base_failed, score (mean log ratio of an n-gram) and kept, per document."""
    worded = with_hashes(docs.select("doc_id", "text"))
    cells = bucket_weights(worded.select("doc_id", "_h1", "_h2"), labels, buckets, max_trusted, smoothing).first()["weights"]
    weights = F.split(F.lit(",".join(map(repr, cells))), ",").cast("array<double>")  # folded into one constant
    scored = measures(worded).withColumn("_weights_sum", F.aggregate(
        grams(), F.lit(0.0), lambda total, h: total + F.get(weights, F.pmod(h, F.lit(buckets)).cast("int"))))
    n_grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        F.round(F.col("_weights_sum") / n_grams, 6).alias("score"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
