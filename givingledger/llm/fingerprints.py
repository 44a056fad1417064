"""Document fingerprints by I-Match: a text's terms within a band of document frequency, sorted, hashed under randomised lexicons.

1. Terms are words in lower case (A-Z), held as 64-bit hashes. Over all documents, the number of documents with each of `buckets`
   hash buckets of terms is counted. The lexicon is the set of buckets between the shares `low` and `high` of all documents (never
   below 2 documents): a bitmap of `buckets` bits whatever the corpus is, which enters the later passes as a constant.
2. A text keeps its distinct terms in the lexicon, sorted; a text without such terms all its terms, one without terms itself.
3. `LEXICONS` randomised subsets of the lexicon, subset k with a share of RATE ** k of all terms, are fixed by hash. A fingerprint
   is the hash of the kept terms of each subset, 8 hex digits or 8 dashes for none. Large subsets tell short texts apart, small
   ones survive edits in long texts.
4. The likeness of two fingerprints is the share of equal hashes among the `SPARSEST` smallest subsets that hold terms of either:
   1 for equal texts. Larger subsets hold many terms of a text, one of which an edit nearly always changes.

DataFrame functions only. Null text counts as empty. Texts are read in whole; a text is held by one row. Equal texts have equal
fingerprints, so repeated rows and ties need no order. An empty table gives an empty result. Other columns are kept as they are;
one called like a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from givingledger.llm.common import PUNCTUATION, lower_ascii, sha256_of, split_words, written

BUCKETS = 1 << 20
LEXICONS = 48
RATE = 0.86
SPARSEST = 16
NONE = "-" * 8


def terms(text: Column) -> Column:
    """The distinct term hashes of a text, in no order."""
    plain = F.octet_length(text) == F.length(text)  # all ASCII, where lower() is the same and much faster
    lowered = F.when(plain, F.lower(text)).otherwise(lower_ascii(text))
    return F.array_distinct(F.transform(split_words(lowered, PUNCTUATION), lambda w: F.xxhash64(w)))


def lexicon_rows(docs: DataFrame, low: float, high: float, buckets: int) -> DataFrame:
    """(place, bits): the lexicon's bitmap in words of 64 bits, without those that are 0."""
    found = F.array_distinct(F.transform(terms(F.col("text").cast("string")), lambda t: F.pmod(t, F.lit(buckets))))
    counts = docs.select(F.explode(found).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    total = docs.agg(F.count(F.lit(1)).alias("total"))
    band = counts.join(F.broadcast(total)).filter(f"n >= greatest(2D, total * {low}D) AND n <= greatest(2D, total * {high}D)")  # one row
    bit = F.expr("shiftleft(1L, CAST(bucket & 63 AS int))")
    return band.groupBy(F.shiftright("bucket", 6).alias("place")).agg(F.bit_or(bit).alias("bits"))


def fitted_lexicon(docs: DataFrame, low: float = 1 / 4096, high: float = 1 / 16, buckets: int = BUCKETS) -> Column:
    """The lexicon of docs (text) as a constant array of buckets / 64 numbers, the bound on what the driver reads."""
    bits = [0] * (buckets // 64)
    for row in lexicon_rows(docs, low, high, buckets).collect():
        bits[row["place"]] = row["bits"]
    return F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>")


def subset_hashes(text: Column, lexicon: Column, buckets: int = BUCKETS) -> Column:
    """The hash of a text's kept terms in each subset, null where there is none."""

    def listed(term: Column) -> Column:
        place = F.pmod(term, F.lit(buckets)).cast("int")
        word = F.get(lexicon, F.shiftright(place, 6))
        # shift by a column, which the function of this name does not take
        return F.call_function("shiftright", word, place.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1)) == 1

    def kept(every: Column) -> Column:
        banded = F.filter(every, listed)
        return F.transform(F.array(banded), lambda b: F.when(F.size(b) > 0, b).when(F.size(every) > 0, every).otherwise(F.array(F.xxhash64(text))))[0]

    def subset(held: Column, k: int) -> Column:
        """Shares and numbers of subsets are constants: this runs for each term and subset. The first one holds all terms."""
        return held if k == 0 else F.filter(held, lambda t: F.shiftrightunsigned(F.xxhash64(t, F.lit(k)), 1) <= F.lit(int(RATE**k * 2.0**63)))

    def subsets(held: Column) -> Column:
        members = F.array(*[subset(held, k) for k in range(LEXICONS)])
        return F.transform(members, lambda m: F.when(F.size(m) > 0, F.hash(m)))

    # sort_array compares numbers; array_sort would run a comparison of its own for each two of them
    return F.transform(F.transform(F.array(F.sort_array(terms(text))), kept), subsets)[0]


def spelled(hashes: Column) -> Column:
    """The fingerprint as text."""
    digits = lambda h: F.lpad(F.lower(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")
    return F.array_join(F.transform(hashes, lambda h: F.coalesce(digits(h), F.lit(NONE))), "")


def likeness(one: Column, other: Column) -> Column:
    """Share of equal hashes (arrays of subset_hashes) among the sparsest subsets that hold terms of either."""
    pairs = F.filter(F.arrays_zip(one.alias("x"), other.alias("y")), lambda p: p["x"].isNotNull() | p["y"].isNotNull())
    held = F.slice(F.reverse(pairs), 1, SPARSEST)
    return F.transform(F.array(held), lambda h: F.size(F.filter(h, lambda p: F.coalesce(p["x"] == p["y"], F.lit(False)))) / F.size(h))[0]


def fingerprinted(docs: DataFrame, lexicon: Column | None = None) -> DataFrame:
    """docs with their fingerprint. Without a lexicon, the one of docs."""
    lexicon = fitted_lexicon(docs) if lexicon is None else lexicon
    return docs.withColumn("fingerprint", spelled(subset_hashes(F.coalesce(F.col("text").cast("string"), F.lit("")), lexicon)))


# --- each document against its next one and against an edited copy


KEY = ["named", "id"]  # of a doc_id; null comes first


def order_of(rows: DataFrame) -> DataFrame:
    """(named, id, need, first_named, first_id, first_hash) for each doc_id: the next one in ascending order, after the last the
    first; `need` code points of the next document are wanted, and the one with the least text hash stands for an id.

    Ids are laid out by range, so that the next one is found within a partition; between partitions it is the next partition's
    first, of a table with a row for each partition.
    """
    ids = rows.groupBy(*KEY).agg(F.max(F.floor(F.length("text") / 4)).alias("need"), F.min("hash").alias("hash"))
    laid = written(ids.repartitionByRange(*KEY).withColumn("part", F.spark_partition_id()), "ids")
    one = F.struct(*KEY, "hash")
    following = F.lead(one).over(Window.partitionBy("part").orderBy(*KEY))
    firsts = laid.groupBy("part").agg(F.min(one).alias("first"))
    by_part = Window.orderBy("part")
    ends = firsts.select("part", F.coalesce(F.lead("first").over(by_part), F.min("first").over(Window.partitionBy(F.lit(0)))).alias("after"))
    found = laid.withColumn("next", following).join(F.broadcast(ends), "part")  # a row for each partition
    return found.select(*KEY, "need", F.coalesce("next", "after").alias("next")).select(*KEY, "need", *[f"next.{c}" for c in (*KEY, "hash")])


def edited_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per document.

    An edited text has its last quarter (code points, rounded down) replaced by as much of the next document's start. Rows with
    one doc_id all have the same next document; of several rows with the next id, the one with the least 64-bit hash of its text.
    Texts move once, by doc_id, for both joins, and a quarter of them once more.
    """
    texts = docs.select(
        F.col("doc_id").isNotNull().alias("named"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    lexicon = fitted_lexicon(docs)
    order = written(order_of(texts.withColumn("hash", F.xxhash64("text"))).toDF(*KEY, "need", "to_named", "to_id", "to_hash"), "order")
    rows = texts.withColumn("hashes", subset_hashes(F.col("text"), lexicon))
    wanted = order.select(F.col("named").alias("of_named"), F.col("id").alias("of_id"), "need", F.col("to_named").alias("named"), F.col("to_id").alias("id"), "to_hash")
    # The hash is the least of its id's, so "at most" means equal; the form keeps it out of the join's keys, and so the layout as it is.
    heads = rows.join(wanted, KEY).filter(F.xxhash64("text") <= F.col("to_hash"))
    heads = heads.select("of_named", "of_id", F.expr("substring(text, 1, CAST(need AS int))").alias("head"), F.col("hashes").alias("next_hashes"))
    heads = heads.groupBy(F.col("of_named").alias("named"), F.col("of_id").alias("id")).agg(*[F.first(c).alias(c) for c in ("head", "next_hashes")])
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    met = rows.join(heads, KEY).select(
        *KEY, n.cast("long").alias("n_chars"), "hashes", "next_hashes",
        F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("head", F.lit(1), quarter)).alias("edited"))
    both = met.withColumn("edited_hashes", subset_hashes(F.col("edited"), lexicon))
    return both.select(
        F.when(F.col("named"), F.col("id")).alias("doc_id"), "n_chars", sha256_of(F.col("edited")).alias("edited_sha256"),
        spelled(F.col("hashes")).alias("fingerprint"), spelled(F.col("edited_hashes")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"), likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"))
