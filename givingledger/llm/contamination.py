"""Benchmark decontamination with a distributed positional inverted index. DataFrame functions only.

1. Index: one posting (term, doc_id, pos) for every document word that any benchmark item uses, stored as a table. Other
   words cannot take part in a match.
2. Every window (13 consecutive item words; a shorter item is one window) is anchored at its rarest word, by the number of
   postings. Postings of anchor terms, moved back by the anchor's offset, are the first candidates: (item, doc, start of the
   item). The list of the window's second rarest word, moved likewise, is intersected with them.
3. What is left is compared word by word with the postings around the anchors, and runs of 13 or more matching neighbours
   are the exact matches.

Proximity matches: an item all of whose words, in any order, lie at most its own length and `INSERTED` words from a place of its
rarest word; report() gives them over the same postings.

Everything is keyed by (document, position), which no frequent word or passage can make uneven. The vocabulary, anchors and
item words are as large as the benchmark; they are broadcast only if they have at most `MAX_BROADCAST` rows, likewise the keys
of candidate documents; beyond that the same joins are shuffled. A document's key is its doc_id with a hash of its text:
repeated rows share their postings, and rows with one doc_id but other texts stay apart. Each document also has a posting of
the end mark, whose place is its length.

Null and empty texts have no words: no hits, not contaminated. Null or empty items have no window. Repeated items match one
by one. Null ids are kept. Empty tables give empty or unmatched results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from givingledger.llm.common import PUNCTUATION, fresh_names, lower_ascii, sha256_of, split_words, written

WINDOW = 13
INSERTED = 8  # words that a proximity match may hold besides the item's
MAX_BROADCAST = 1_000_000
END_MARK, END_TERM = "", 0


def words_of(text: str = "text") -> Column:
    return split_words(lower_ascii(F.col(text)), PUNCTUATION)


def bounded(df: DataFrame) -> DataFrame:
    """df to be broadcast if it is counted to be small; else as it is."""
    n = df.limit(MAX_BROADCAST + 1).count()
    return F.broadcast(df) if n <= MAX_BROADCAST else df


def document_key() -> Column:
    return F.struct("doc_id", F.xxhash64("text").alias("hash"))


def item_words(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, n, j, word): item is a key of the row, so that repeated ids stay apart."""
    rows = benchmark.select("item_id", words_of().alias("words")).filter(F.size("words") > 0)
    keyed = rows.select(F.monotonically_increasing_id().alias("item"), "item_id", "words")
    return keyed.select("item", "item_id", F.size("words").alias("n"), F.posexplode("words").alias("j", "word"))


def build_index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Postings (term, doc, pos) of the words in vocabulary (word, term), as a stored table; docs has doc and text."""
    tokens = docs.select("doc", F.posexplode(F.array_append(words_of(), END_MARK)).alias("pos", "word"))
    return written(tokens.join(bounded(vocabulary), "word").select("term", "doc", "pos"), "postings")


def anchors(items: DataFrame, frequency: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, j, term, j2, term2, lo, hi): item places that are the rarest of a window, the window's second rarest, and the
    stretch of the item that the windows with this pair cover. Windows with a word that no document has are left out."""
    known = items.join(frequency, "term", "left").withColumn("freq", F.coalesce("freq", F.lit(0)))
    starts = known.select(
        "item", F.explode(F.sequence(F.greatest(F.col("j") - (window - 1), F.lit(0)),
                                     F.least(F.col("j"), F.greatest(F.col("n") - window, F.lit(0))))).alias("start"),
        "n", F.struct("freq", "j", "term").alias("place"))
    windows = starts.groupBy("item", "start", "n").agg(F.sort_array(F.collect_list("place")).alias("places"))
    first, second = F.col("places")[0], F.coalesce(F.get("places", F.lit(1)), F.col("places")[0])
    return (
        windows.filter(first["freq"] > 0)
        .select("item", first["j"].alias("j"), first["term"].alias("term"), second["j"].alias("j2"), second["term"].alias("term2"),
                "start", (F.least(F.col("start") + window, F.col("n")) - 1).alias("end"))
        .groupBy("item", "j", "term", "j2", "term2").agg(F.min("start").alias("lo"), F.max("end").alias("hi"))
    )


def diagonals(postings: DataFrame, anchored: DataFrame) -> DataFrame:
    """(doc, item, shift, lo, hi): an item that starts at `shift` of a document by its two rarest words in a window."""
    keys = written(anchored, "anchors")
    first = (
        postings.join(bounded(keys), "term")
        .select("doc", "item", (F.col("pos") - F.col("j")).alias("shift"), "term2", (F.col("pos") - F.col("j") + F.col("j2")).alias("pos"), "lo", "hi")
        .distinct()
    )
    rare = postings.join(bounded(keys.select(F.col("term2").alias("term")).distinct()), "term", "left_semi")
    second = rare.select("doc", F.col("term").alias("term2"), "pos").distinct()
    both = first.join(second, ["doc", "pos", "term2"])
    return both.groupBy("doc", "item", "shift").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def phrase_matches(postings: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Exact matches (doc, item, item_id, first, last): maximal runs of at least a window, as word places of the document."""
    frequency = postings.groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
    found = written(diagonals(postings, anchors(items, frequency, window)), "candidates")
    expected = (
        found.join(bounded(items), "item").filter("j >= lo AND j <= hi")
        .select("doc", (F.col("shift") + F.col("j")).alias("pos"), "term", "item", "item_id", "n", "shift", "j")
    )
    near = postings.join(bounded(found.select("doc").distinct()), "doc", "left_semi").select("doc", "pos", "term").distinct()
    matched = expected.join(near, ["doc", "pos", "term"])
    order = Window.partitionBy("doc", "item", "shift").orderBy("j")
    runs = matched.withColumn("run", F.col("j") - F.row_number().over(order)).groupBy("doc", "item", "item_id", "n", "shift", "run").agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"))
    whole = F.col("last") - F.col("first") + 1 >= F.least(F.lit(window), F.col("n"))
    return runs.filter(whole).select("doc", "item", "item_id", "first", "last")


def proximity_matches(postings: DataFrame, items: DataFrame, slop: int | None = None) -> DataFrame:
    """(doc, item, item_id, pos): places of an item's rarest word with every other item word at most `slop` words away.

    Words are compared as a set, in any order. Without `slop` it is the item's length and `INSERTED` words. Only strips beside an
    anchor are looked at, first for the item's second rarest word, and for the others only where that one is found.
    """
    frequency = postings.groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
    reach = (F.col("n") + INSERTED if slop is None else F.lit(slop)).cast("int").alias("slop")
    terms = written(items.select("item", "item_id", reach, "term").distinct().join(frequency, "term", "left").fillna(0, ["freq"]), "terms")
    rarest = terms.groupBy("item", "item_id", "slop").agg(F.sort_array(F.collect_list(F.struct("freq", "term"))).alias("t"))
    anchor = rarest.filter(F.col("t")[0]["freq"] > 0).select(
        "item", "item_id", "slop", F.expr("CAST(power(2, ceil(log2(slop + 1))) AS INT)").alias("width"), F.size("t").alias("n_terms"),
        F.col("t")[0]["term"].alias("term"), F.coalesce(F.get("t", F.lit(1)), F.col("t")[0])["term"].alias("term2"))
    anchor = written(anchor, "near_anchors")
    widths = [r["width"] for r in anchor.select("width").distinct().collect()]  # powers of two
    if not widths:
        return anchor.join(postings.limit(0).select("doc", "pos"), F.lit(False)).select("doc", "item", "item_id", "pos")

    def beside(hits: DataFrame) -> DataFrame:
        return hits.withColumn("strip", F.explode(F.expr("sequence(pos DIV width - 1, pos DIV width + 1)")))

    def stripped(places: DataFrame) -> DataFrame:
        strips = F.array(*[F.struct(F.lit(w).alias("width"), F.expr(f"pos DIV {w}").alias("strip")) for w in widths])
        return places.select("doc", "term", F.col("pos").alias("at"), F.inline(strips))

    keys = ["doc", "term", "width", "strip"]
    within = F.abs(F.col("at") - F.col("pos")) <= F.col("slop")
    hits = written(postings.join(bounded(anchor), "term").drop("term").withColumnRenamed("term2", "term"), "near_hits")
    second = stripped(postings.join(bounded(anchor.select(F.col("term2").alias("term")).distinct()), "term", "left_semi"))
    pairs = beside(hits).join(second, keys).filter(within).select("doc", "pos", "item", "item_id", "slop", "width", "n_terms").distinct()
    pairs = written(pairs, "near_pairs")
    near = stripped(postings.join(bounded(pairs.select("doc").distinct()), "doc", "left_semi"))
    met = beside(pairs.join(bounded(terms.select("item", "term")), "item")).join(near, keys).filter(within)
    counted = met.select("doc", "item", "item_id", "pos", "n_terms", "term").distinct().groupBy("doc", "item", "item_id", "pos", "n_terms").agg(
        F.count(F.lit(1)).alias("met"))
    return counted.filter("met = n_terms").select("doc", "item", "item_id", "pos")


def index_both(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings of docs (doc, text), and item words with their terms."""
    words = written(item_words(benchmark), "items")
    terms = words.groupBy("word").agg(F.min(F.struct("item", "j")).alias("key")).select(
        "word", F.xxhash64("key.item", "key.j").alias("term"))
    mark = docs.sparkSession.range(1).select(F.lit(END_MARK).alias("word"), F.lit(END_TERM).cast("long").alias("term"))
    vocabulary = written(terms.unionByName(mark), "vocabulary")
    items = written(words.join(vocabulary, "word").drop("word"), "item_terms")
    return build_index(docs, vocabulary), items


def items_of(matches: DataFrame) -> DataFrame:
    """(doc, n_items, items): how many items, and their ids joined."""
    return matches.select("doc", "item_id").distinct().groupBy("doc").agg(
        F.count("item_id").alias("n_items"),
        F.concat_ws(",", F.sort_array(F.collect_list(F.col("item_id").cast("string")))).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and doc (the document's key) per document."""
    return exact(*index_both(docs.select(document_key().alias("doc"), "text"), benchmark), window)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The columns of contamination, and the items near by: n_near, near_sha256; they do not decide on contaminated."""
    postings, items = index_both(docs.select(document_key().alias("doc"), "text"), benchmark)
    near = items_of(proximity_matches(postings, items)).select("doc", F.col("n_items").alias("_n"), F.col("items").alias("_items"))
    near = written(near, "near")
    found = exact(postings, items, window)
    return found.join(bounded(near), "doc", "left").select(
        *found.columns, F.coalesce("_n", F.lit(0)).cast("long").alias("n_near"), sha256_of(F.coalesce("_items", F.lit(""))).alias("near_sha256"))


def exact(postings: DataFrame, items: DataFrame, window: int) -> DataFrame:
    matches = written(phrase_matches(postings, items, window), "matches")
    places = matches.select("doc", F.explode(F.sequence("first", "last")).alias("pos")).distinct()
    hit = places.groupBy("doc").agg(F.count(F.lit(1)).alias("n_hit"))
    found = written(hit.join(items_of(matches), "doc"), "hits")
    lengths = postings.filter(F.col("term") == END_TERM).select("doc", F.col("pos").cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return lengths.join(bounded(found), "doc", "left").select(
        "doc.doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        sha256_of(F.coalesce("items", F.lit(""))).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "doc")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated; same columns."""
    mine, key = fresh_names(docs.columns, "key", "bad_key")
    bad = written(contamination(docs, benchmark).filter("contaminated").select(F.col("doc").alias(key)).distinct(), "contaminated")
    return docs.withColumn(mine, document_key()).join(bounded(bad), F.col(mine).eqNullSafe(F.col(key)), "left_anti").drop(mine)
