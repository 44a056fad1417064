"""Best-fit packing into sequences of several permitted lengths.

Lengths are words plus one end mark per document (or any given column); a document longer than the largest permitted length is
cut into pieces of that length, and its rest is a piece too. Pieces are spread over groups of about `group_tokens` tokens by a
hash of document, piece and copy, so a frequent id cannot fill a group; each group is packed by itself:

- pieces come longest first and go to the open bin that they fill best;
- if none has room, a bin is opened, of the preferred length or, if that is too short, of the length with the least cost for each
  token of room among those that hold the piece;
- at the end each bin is cut down to the cheapest permitted length that holds its contents;
- this is done with each permitted length as the preferred one, and the cheapest of these packings counts, so that the lengths
  are chosen for the pieces that a group has, all together.

cost(L) = overhead + L + L * L / quadratic. One row per bin: bin_id, seq_len, used, doc_ids and pieces (doc_id, start, length).
Null and empty texts are pieces of one end mark. Repeated rows are packed as often as they occur. Ties go to the smaller
length, the earlier bin, the smaller doc_id. An empty table gives no bin.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from givingledger.llm.common import SPACE, split_words, written

LENGTHS = (512, 1024, 2048, 4096, 8192)
OVERHEAD, QUADRATIC = 256.0, 32768.0
NO_ID = -(1 << 63)
BINS = "bin_id string, seq_len int, used int, doc_ids array<long>, pieces array<struct<doc_id:long,start:long,length:int>>"


def cost(length: int) -> float:
    return OVERHEAD + length + length * length / QUADRATIC


def pack(lengths: Sequence[int], permitted: Sequence[int]) -> list[tuple[int, list[int]]]:
    """(final length, places of its pieces) of each bin of the cheapest packing; lengths are in falling order."""
    packings = [pack_preferring(first, lengths, permitted) for first in sorted(permitted, key=lambda size: (cost(size) / size, size))]
    return min(packings, key=lambda bins: sum(cost(size) for size, _ in bins))  # of equal ones the first


def pack_preferring(first: int, lengths: Sequence[int], permitted: Sequence[int]) -> list[tuple[int, list[int]]]:
    """The same with bins of one length opened first."""
    by_value = [first, *sorted(permitted, key=lambda size: (cost(size) / size, size))]
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for place, length in enumerate(lengths):
        at = bisect_left(room, (length, -1))
        if at < len(room):
            free, chosen = room.pop(at)
        else:
            free, chosen = next(size for size in by_value if size >= length), len(bins)
            bins.append([])
        bins[chosen].append(place)
        if free > length:
            insort(room, (free - length, chosen))
    used = [sum(lengths[p] for p in places) for places in bins]
    return [(min((s for s in permitted if s >= u), key=lambda s: (cost(s), s)), places) for u, places in zip(used, bins, strict=True)]


def pieces(rows: DataFrame, largest: int) -> DataFrame:
    """(doc_id, copy, start, length) of rows (doc_id, length); equal rows are counted first and told apart by copy."""
    counted = rows.groupBy("doc_id", "length").agg(F.count(F.lit(1)).alias("copies"))
    copied = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    cut = copied.withColumn("start", F.explode(F.expr(f"sequence(0L, length - 1, {largest}L)")))
    return cut.select("doc_id", "copy", "start", F.least(F.col("length") - F.col("start"), F.lit(largest)).cast("int").alias("length"))


def pack_documents(docs: DataFrame, permitted: Sequence[int] = LENGTHS, length: str | None = None,
                   group_tokens: int = 1 << 22) -> DataFrame:
    """Bins of docs (doc_id, text); `length` names a column with lengths of at least 1, else words are counted."""
    permitted = tuple(sorted(set(permitted)))
    counted = F.size(split_words(F.col("text").cast("string"), SPACE)) + 1 if length is None else F.greatest(F.coalesce(length, F.lit(1)), F.lit(1))
    cut = written(pieces(docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), counted.cast("long").alias("length")), permitted[-1]), "pieces")
    total = cut.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    groups = max(1, -(-total // group_tokens))
    grouped = cut.withColumn("group", F.pmod(F.xxhash64("doc_id", "copy", "start", "length"), F.lit(groups)).cast("int"))

    def pack_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "copy", "start"], ascending=[False, True, True, True])
        ids, starts, sizes = (rows[c].tolist() for c in ("doc_id", "start", "length"))
        ids = [None if x == NO_ID else x for x in ids]
        found = []
        for number, (size, places) in enumerate(pack(sizes, permitted)):
            content = [{"doc_id": ids[p], "start": starts[p], "length": sizes[p]} for p in places]
            found.append((f"{rows['group'].iloc[0]}-{number}", size, sum(sizes[p] for p in places), [ids[p] for p in places], content))
        return pd.DataFrame(found, columns=["bin_id", "seq_len", "used", "doc_ids", "pieces"])

    return grouped.groupBy("group").applyInPandas(pack_group, BINS)
