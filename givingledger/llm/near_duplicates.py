"""N-gram Jaccard join: a grouped prefix join over sets of 5-word shingles, similarity 0.8 or more.

1. Frequent shingles (twice or more in one block of rows, the `HOT_ROWS` commonest) rank last, all others by hash: one order
   for all sets. It steers work only; any order gives the same links.
2. Equal sets are one class; classes with equal size and prefix are one group. The index holds the prefix of one document
   of each group, as rows (token, group, size, place).
3. Rounds, at present one: in each token's list, by size band, one group is the pivot, in later rounds several; each group proposes
   a link to those of other components with which it shares enough, in the first round only the most. There the pivot is the group
   whose prefix has most of what many texts share, so that near copies of one text all meet the one with least of its own; in later
   rounds chance decides. Members of a proposed pair are expanded and verified on whole sets; verified links join components. Rows
   grow with the lists, not with their squares, and large groups of near copies become one component.
4. Rest: in lists that still hold more than one component, groups outside a list's largest component meet the whole list, in
   a second prefix: each group's tokens by the length of their lists, without the last ones, of which a similar pair shares more.
   Pairs of different components that pass the length, place and signature filters are taken once, their shared tokens counted,
   and expanded and verified. So no link between different components is lost, and long lists are seldom needed.

A signature of a set says of 512 buckets whether each holds an odd number of its shingles. Two sets differ in at least as many
shingles as their signatures in bits, and similar sets of n and m shingles in at most (n + m) / 9. A group of several classes has
the bits in which all of them agree. So signatures only drop pairs that cannot link, at a size that no text makes larger.

Sets are compared by 64-bit shingle hashes. A row without words has the empty set and no link. Null text counts as empty.
Each row counts by itself: a row's key is a 128-bit digest of its doc_id and text, equal only in repeated rows, and classes have
numbers of their own. So rows with one doc_id but other texts stay apart, and rows with a null doc_id are linked like others. A
component is reported by its smallest doc_id, null if none of its rows has one. Empty tables give empty results; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from givingledger.llm.common import fresh_names, slices, small_batches, written
from givingledger.llm.components import components
from givingledger.llm.shingles import mix, shingle_sets

HOT_ROWS = 1 << 17
MAX_BROADCAST = 1_000_000
PIVOTS = (1,)  # of each list, by round; they spare work, step 4 finds what they leave
BATCH = 1_000  # rows that go through Python at once
BITS = 512
ROW = ["row_hi", "row_lo"]
CLASS = ["n", "set_hi", "set_lo", "prefix_hi", "prefix_lo"]  # a set has one prefix
SIGNATURE = [f"s{k}" for k in range(BITS // 64)]
OF_SET = [*SIGNATURE, "weight"]  # weight: how often, as a sum of logarithms, the frequent shingles of the prefix are met
SKETCH = ", ".join(f"{c} long" for c in ("doc_id", *ROW, *CLASS, *OF_SET)) + ", prefix array<long>"
GROUP = ["n", "prefix_hi", "prefix_lo"]


def prefix_length(n: int) -> int:
    return n - -(-4 * n // 5) + 1


def digest(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, in no order."""
    with np.errstate(over="ignore"):
        pair = mix(tokens).sum(dtype=np.uint64), mix(tokens ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return int(pair[0].astype(np.int64)), int(pair[1].astype(np.int64))


def signature(tokens: np.ndarray) -> np.ndarray:
    """Of each bucket of a set's tokens, whether their number is odd, as bits of whole numbers."""
    bucket = (mix(tokens ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)) % np.uint64(BITS)
    odd = np.bincount(bucket.astype(np.int64), minlength=BITS) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def row_key() -> list[Column]:
    """128 bits of a row's doc_id and text."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return [F.xxhash64(F.lit(k), doc_id.isNull(), doc_id, text).alias(c) for k, c in enumerate(ROW)]


def bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST else df


def hot_tokens(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens met twice or more in a block of rows, in order, and how often; at most HOT_ROWS, the commonest."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            tokens, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(tokens[n > 1].view(np.int64)), pa.array(n[n > 1])], names=["token", "n"])

        size = 0
        for batch in slices(batches, BATCH):
            for _, tokens in shingle_sets(batch.column("text")):
                held.append(tokens)
                size += len(tokens)
                if size > 1_000_000:
                    yield counted()
                    size = 0
        yield counted()

    counts = docs.select(F.col("text").cast("string")).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    found = counts.filter("n > 4").orderBy(F.desc("n"), "token").limit(HOT_ROWS).toPandas()
    tokens = found["token"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], found["n"].to_numpy(dtype=np.int64)[order]


def sketches(docs: DataFrame) -> DataFrame:
    """For each row its set's size, digest, signature and weight, and the prefix with its digest; stored."""
    hot = docs.sparkSession.sparkContext.broadcast(hot_tokens(docs))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_hot, n_hot = hot.value
        for batch in slices(batches, BATCH):
            rows: list[list] = [[] for _ in range(6 + len(OF_SET))]
            for _, tokens in shingle_sets(batch.column("text")):
                size = prefix_length(len(tokens)) if len(tokens) else 0
                at = np.minimum(np.searchsorted(tokens_hot, tokens), max(len(tokens_hot) - 1, 0))
                hits = tokens_hot[at] == tokens if len(tokens_hot) else np.zeros(len(tokens), dtype=bool)
                cold = tokens[~hits]
                prefix, weight = cold[:size], 0
                if len(prefix) < size:
                    warm, often = tokens[hits], n_hot[at[hits]]
                    first = np.lexsort((warm, often))[: size - len(prefix)]
                    prefix, weight = np.concatenate([prefix, warm[first]]), int(256 * np.log2(often[first]).sum())
                values = (len(tokens), *digest(tokens), *digest(prefix), *signature(tokens), weight, prefix.view(np.int64))
                for column, value in zip(rows, values, strict=True):
                    column.append(value)
            arrays = [pa.array(c, pa.int64()) for c in rows[:-1]] + [pa.array(rows[-1], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", *ROW)], *arrays], schema=pa.schema(
                [pa.field(c, pa.int64()) for c in ("doc_id", *ROW, *CLASS, *OF_SET)] + [pa.field("prefix", pa.list_(pa.int64()))]))

    return written(docs.select(F.col("doc_id").cast("long"), *row_key(), F.col("text").cast("string")).mapInArrow(sketch, SKETCH), "sketches")


def token_sets(docs: DataFrame, ids: DataFrame, few: bool, classes: DataFrame, repeated: bool) -> DataFrame:
    """(id, tokens) of the classes listed in ids (id), each once. few: there are not more ids than a broadcast may hold."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH):
            found = [tokens.view(np.int64) for _, tokens in shingle_sets(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(pa.int64()))], names=["id", "tokens"])

    listed = F.broadcast(ids) if few else bounded(ids)
    wanted = classes.select(F.col("class").alias("id"), *ROW).join(listed, "id", "left_semi")
    wanted = wanted if listed is ids else F.broadcast(wanted)  # a row for each id
    texts = docs.select(*row_key(), F.col("text").cast("string").alias("text")).join(wanted, ROW).select("id", "text")
    texts = texts.groupBy("id").agg(F.first("text").alias("text")) if repeated else texts
    return texts.mapInArrow(sets, "id long, tokens array<long>")


def verified(docs: DataFrame, pairs: DataFrame, n_pairs: int, classes: DataFrame, repeated: bool) -> DataFrame:
    """The pairs (a, b) of classes, stored, whose sets are similar. Only sets of listed classes move, once for a pair."""
    few = n_pairs <= MAX_BROADCAST
    ones, others = (pairs.select(F.col(c).alias("id")).distinct() for c in ("a", "b"))
    left = token_sets(docs, ones, few, classes, repeated).withColumnsRenamed({"id": "a", "tokens": "x"}).join(
        F.broadcast(pairs) if few else pairs, "a")
    both = left.join(token_sets(docs, others, few, classes, repeated).withColumnRenamed("id", "b"), "b")
    common = F.size(F.array_intersect("x", "tokens"))
    return both.filter(100 * common >= 80 * (F.size("x") + F.size("tokens") - common)).select("a", "b")


def relabelled(labels: DataFrame, links: DataFrame, n_links: int) -> DataFrame:
    """labels (id, component) after joining components by verified links (a, b)."""
    ends = links.join(labels.withColumnsRenamed({"id": "a", "component": "ca"}), "a").join(
        labels.withColumnsRenamed({"id": "b", "component": "cb"}), "b")
    merged = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    to = merged.select(F.col("component").alias("to"), F.col("id").alias("component"))
    moved = labels.join(F.broadcast(to) if 2 * n_links <= MAX_BROADCAST else to, "component", "left")
    return written(moved.select("id", F.coalesce("to", "component").alias("component")), "labels")


def group_state(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(g, c_min, c_max, weight): the components that a group's classes belong to, and the weight of its prefix."""
    return members.join(labels.withColumnRenamed("id", "class"), "class").groupBy("g").agg(
        F.min("component").alias("c_min"), F.max("component").alias("c_max"), F.max("weight").alias("weight"))


def open_lists(index: DataFrame, state: DataFrame, few: bool) -> DataFrame:
    """Index rows of the lists that hold more than one component. few: there are not more groups than a broadcast may hold."""
    rows = index.join(F.broadcast(state) if few else state, "g")
    mixed = rows.groupBy("token").agg(F.min("c_min").alias("low"), F.max("c_max").alias("high")).filter("low != high").select("token")
    return rows.join(mixed, "token")


def proposals(rows: DataFrame, round_: int) -> DataFrame:
    """(a, b): to each group pivots of its lists, by size band, of other components, with which it may be similar."""
    n_pivots = PIVOTS[round_]
    banded = rows.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25)) + 0.5 * round_))
    kept = ("g", "n", "place", "c_min", "c_max")
    lightness = F.lit(0) if round_ else -F.col("weight")
    lowest = [F.min(F.struct(lightness.alias("lightness"), F.xxhash64("g", F.lit(100 * round_ + k)).alias("rank"), *kept)) for k in range(n_pivots)]
    chosen = banded.groupBy("token", "band").agg(F.array(*lowest).alias("chosen"))
    distinct = F.array_distinct(F.transform("chosen", lambda p: F.struct(*[p[c].alias(c) for c in kept])))
    pivots = chosen.select("token", "band", F.explode(distinct).alias("p"))
    met = banded.join(pivots, ["token", "band"]).filter("g != p.g AND NOT (c_min = c_max AND p.c_min = p.c_max AND c_min = p.c_min)")
    near = met.filter("5 * least(n, p.n) >= 4 * greatest(n, p.n)")
    shared = near.groupBy("g", F.col("p.g").alias("pivot"), "n", F.col("p.n").alias("m")).agg(
        F.count(F.lit(1)).alias("shared"), F.max("place").alias("last"), F.max("p.place").alias("last_p"))
    likely = shared.filter(9 * F.expr("shared + least(n - last - 1, m - last_p - 1)") >= 4 * (F.col("n") + F.col("m")))
    if n_pivots > 1:
        return likely.select(F.col("g").alias("a"), F.col("pivot").alias("b"))
    best = likely.groupBy("g").agg(F.max(F.struct("shared", F.col("pivot"))).alias("best"))
    return best.select(F.col("g").alias("a"), F.col("best.pivot").alias("b"))


def unlike(known: str = "") -> str:
    """SQL for the number of bits, of those `known` on both sides, in which the signatures of a and b differ."""
    both = [f"({c}_a ^ {c}_b)" + (f" & ~({known}{c}_a | {known}{c}_b)" if known else "") for c in SIGNATURE]
    return "(" + " + ".join(f"bit_count({bits})" for bits in both) + ")"


def signatures(members: DataFrame) -> DataFrame:
    """(g, s0.., not_s0..): of each group the bits that all its classes have, and those in which its classes differ."""
    return members.groupBy("g").agg(*[F.bit_and(c).alias(c) for c in SIGNATURE],
                                    *[F.expr(f"bit_or({c}) ^ bit_and({c})").alias(f"not_{c}") for c in SIGNATURE])


def needed(n: str, m: str) -> str:
    """SQL for the least number of tokens that the prefixes of similar sets of n and m tokens share."""
    return f"((4 * ({n} + {m}) + 8) div 9 - (4 * greatest({n}, {m}) + 4) div 5 + 1)"


def meetings(rows: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b): pairs of groups of different components that can still be similar, from lists in which they meet.

    In each list the component with most groups of its own is the main one; its groups do not meet each other. The tokens of a group
    rank by the length of their lists, those of equal lists together. Of the tokens that a similar pair shares, as many as `needed`,
    the first by rank has all others behind it in both groups, and is the first of its equal lists. So a pair meets only in the first
    of equal lists, and only where both have that many tokens left, which is seldom in long lists. The places of a shared token bound
    the overlap, and signatures the difference.
    """
    same = ["list_hi", "list_lo"]
    counts = rows.groupBy("token", F.expr("if(c_min = c_max, c_min, null)").alias("only")).agg(
        F.count(F.lit(1)).alias("n_groups"), F.min("n").alias("low"), F.max("n").alias("high"),
        *[F.bit_xor(F.xxhash64(F.lit(k), "g")).alias(c) for k, c in enumerate(same)])
    lists = counts.groupBy("token").agg(F.sum("n_groups").alias("length"), F.min("low").alias("low"), F.max("high").alias("high"),
                                        F.max(F.expr("if(only is null, null, struct(n_groups, only))")).alias("main"),
                                        *[F.bit_xor(c).alias(c) for c in same])
    firsts = lists.groupBy("length", *same).agg(F.min("token").alias("token")).select("token")
    ranks = Window.partitionBy("g").orderBy(F.desc("length"), *same, F.desc("token"))
    ranked = rows.join(lists, "token").withColumn("left", F.row_number().over(ranks)).join(firsts, "token", "left_semi")
    # Sizes in the list bound what is needed; whole numbers stray from a straight line by 2 at most.
    able = ranked.filter(f"left + 2 >= least({needed('n', 'greatest(low, 4 * n div 5)')}, {needed('n', 'least(high, 5 * n div 4 + 1)')})")
    marked = able.join(signatures(members), "g").selectExpr(
        "token", "g", "n", "place", "left", "c_min", "c_max", *SIGNATURE, *[f"not_{c}" for c in SIGNATURE],
        "NOT (c_min = c_max AND c_min <=> main.only) AS apart")
    one, two = (marked.select("token", *[F.col(c).alias(f"{c}_{s}") for c in marked.columns if c != "token"]) for s in "ab")
    met = one.filter("apart_a").join(two, "token").filter(f"""
        g_a != g_b AND (NOT apart_b OR g_a < g_b) AND 5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)
        AND NOT (c_min_a = c_max_a AND c_min_b = c_max_b AND c_min_a = c_min_b)
        AND least(left_a, left_b) >= {needed("n_a", "n_b")}
        AND 9 * (least(place_a, place_b) + least(n_a - place_a, n_b - place_b)) >= 4 * (n_a + n_b)
        AND 9 * {unlike("not_")} <= n_a + n_b""")
    return met.select(F.least("g_a", "g_b").alias("a"), F.greatest("g_a", "g_b").alias("b"))


def remaining(rows: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b): the pairs that meet, each once, whose prefixes share as many tokens as they must."""
    pairs = written(meetings(rows, members).distinct(), "met")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("g")).distinct()
    held = rows.join(ends, "g", "left_semi").groupBy("g").agg(F.first("n").alias("n"), F.collect_list("token").alias("tokens"))
    one, two = (held.select(*[F.col(c).alias(to) for c, to in zip(held.columns, to, strict=True)]) for to in (("a", "n", "x"), ("b", "m", "y")))
    both = pairs.join(one, "a").join(two, "b")
    return both.filter(f"size(array_intersect(x, y)) >= {needed('n', 'm')}").select("a", "b")


def expanded(pairs: DataFrame, members: DataFrame, labels: DataFrame, tried: DataFrame, whole: bool) -> DataFrame:
    """Pairs of groups as pairs of classes of different components, with signatures that allow a link, not tried before.

    All classes of the first group meet those of the second; in the rounds, where the second is a pivot, its first class.
    """
    state = members.join(labels.withColumnRenamed("id", "class"), "class")
    one, two = (part.select(F.col("g").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("class", "component", "n", *SIGNATURE)])
                for s, part in (("a", state), ("b", state if whole else state.filter("class = g"))))
    met = pairs.join(one, "a").join(two, "b").filter(
        f"component_a != component_b AND 9 * {unlike()} <= n_a + n_b" + (" AND (a != b OR class_a < class_b)" if whole else ""))
    return met.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")


def first_row() -> Column:
    """The row with the smallest doc_id, those without one last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *ROW, "copies")).alias("first")


def classes_of(sketch: DataFrame) -> DataFrame:
    """(*CLASS, *OF_SET, doc_id, *ROW, copies, class): each class with a number and its first row, there `copies` times; stored."""
    same = [F.max(c).alias(c) for c in OF_SET]  # rows of a class have one signature and weight
    rows = sketch.filter("n > 0").groupBy(*CLASS, "doc_id", *ROW).agg(F.count(F.lit(1)).alias("copies"), *same)
    found = rows.groupBy(*CLASS).agg(first_row(), *same)
    return written(found.select(*CLASS, *OF_SET, "first.doc_id", *[f"first.{c}" for c in ROW], "first.copies",
                                F.monotonically_increasing_id().alias("class")), "classes")


def linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sketches, and each class (*CLASS) with the first row (doc_id, *ROW, copies) of its component; both stored."""
    small_batches(docs.sparkSession)
    sketch = sketches(docs)
    classes = classes_of(sketch)
    repeated = not classes.filter("copies > 1").isEmpty()
    groups = classes.groupBy(*GROUP).agg(F.min("class").alias("g"), F.count(F.lit(1)).alias("n_classes"))
    members = written(classes.join(groups, GROUP).select("g", "class", "n_classes", *GROUP, *ROW, *OF_SET), "members")
    chosen = sketch.join(members.filter("class = g").select("g", *GROUP, *ROW), [*GROUP, *ROW]).dropDuplicates([*GROUP, *ROW])
    exploded = chosen.select("g", "n", F.posexplode("prefix").alias("place", "token"))
    members = members.select("g", "class", "n_classes", "n", *OF_SET)
    by_token = exploded.repartition("token")
    shared = by_token.groupBy("token").agg(F.min("g").alias("low"), F.max("g").alias("high")).filter("low < high").select("token")
    index = written(by_token.join(shared, "token"), "index")
    labels = written(classes.select(F.col("class").alias("id"), F.col("class").alias("component")), "labels")
    few = members.filter("class = g").count() <= MAX_BROADCAST
    inside = members.filter("n_classes > 1").select(F.col("g").alias("a"), F.col("g").alias("b")).distinct()
    tried = labels.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    for round_ in range(len(PIVOTS) + 1):
        last = round_ == len(PIVOTS)
        rows = written(open_lists(index, written(group_state(members, labels), "state"), few), "open")
        wanted = (remaining(rows, members) if last else proposals(rows, round_)).unionByName(inside)
        pairs = written(expanded(wanted, members, labels, tried, whole=last), "pairs")
        n_pairs = pairs.count()
        if not n_pairs:
            continue
        links = written(verified(docs, pairs, n_pairs, classes, repeated), "verified")
        n_links = links.count()
        if n_links:
            labels = relabelled(labels, links, n_links)
        tried = tried.unionByName(pairs).unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return sketch, with_first_rows(classes, labels)


def with_first_rows(classes: DataFrame, labels: DataFrame) -> DataFrame:
    named = classes.join(labels.withColumnRenamed("id", "class"), "class")
    several = named.groupBy("component").agg(first_row(), F.count(F.lit(1)).alias("n_classes")).filter("n_classes > 1")
    joined = named.join(bounded(written(several.select("component", "first"), "several")), "component", "left")
    of = lambda c: F.when(F.col("first").isNull(), F.col(c)).otherwise(F.col(f"first.{c}")).alias(c)
    return written(joined.select(*CLASS, *[of(c) for c in ("doc_id", *ROW, "copies")]), "first_rows")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach) per document row."""
    sketch, first = linked(docs)
    joined = sketch.select("doc_id", *CLASS).join(first.select(*CLASS, F.col("doc_id").alias("component")), CLASS, "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def first_of_each(docs: DataFrame) -> DataFrame:
    """Exactly one row of each component, one with the smallest id; same columns. Rows without words stay.

    The keys that go are joined, fewer than those that stay; texts are not shuffled unless very many go. Only rows of a first
    key that is there repeatedly are grouped, combined before the shuffle; of those the least in the other columns stays.
    """
    sketch, first = linked(docs)
    keys = fresh_names(docs.columns, *ROW)
    mine = sketch.filter("n > 0").select(*CLASS, *ROW)
    met = mine.join(first.select(*CLASS, *[F.col(c).alias(f"first_{c}") for c in ROW]), CLASS)
    gone = met.filter(" OR ".join(f"{c} != first_{c}" for c in ROW)).select(*[F.col(c).alias(k) for c, k in zip(ROW, keys, strict=True)]).distinct()
    again = written(first.filter("copies > 1").select(*[F.col(c).alias(k) for c, k in zip(ROW, keys, strict=True)]).distinct(), "repeated")
    columns = docs.columns
    keyed = docs.select(*columns, *[column.alias(k) for column, k in zip(row_key(), keys, strict=True)])
    kept = keyed.join(bounded(written(gone, "gone")), keys, "left_anti")
    if again.isEmpty():
        return kept.select(*columns)
    ranked = [F.col(c).alias(f"c{i}") for i, c in enumerate(columns) if c not in ("doc_id", "text") and "map<" not in docs.schema[c].dataType.simpleString()]
    least = F.min_by(F.struct(*columns), F.struct(F.lit(0).alias("zero"), *ranked)).alias("row")
    one = keyed.join(bounded(again), keys, "left_semi").groupBy(*keys).agg(least)
    return kept.join(bounded(again), keys, "left_anti").select(*columns).unionByName(one.select("row.*"))
