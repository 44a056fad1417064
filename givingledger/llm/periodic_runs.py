"""Periodic runs of words, by a suffix automaton whose suffix-link tree is a link-cut tree.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends, of at least max(6, 4 * q) words.

1. Each appended word extends the automaton of the words so far. The tree of suffix links is kept as a link-cut tree: paths of
   states with one last occurrence are splay trees. Access from the new state recolours its root path. Where that path meets a
   segment that was last seen ending at word e, the deepest state there has the length l of the longest common suffix of both
   ends; if the distance d = i - e is within the segment's lengths, the last 2 * d words are a square with a primitive root, and
   they extend to the left up to word i - l - d + 1. A run is named by that start and d, and ends with the last such i.
2. Before that, stretches that cannot hold a run are left out: inside a run each stretch of five words occurs again q words away,
   and q is at most a quarter of the run. This is a bound, so no run is lost, and runs never reach over the edge of a stretch.

Words are runs of characters other than \\x20 and \\x09-\\x0D, compared exactly. Rows are independent of each other: a text is held by one
task, in memory in proportion to it. Null and empty texts have no words and no runs. Repeated rows give repeated results, an empty table
an empty one. Other columns are kept as they are; one called like a result column is replaced.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from givingledger.llm.common import fresh_names

LEAST, TIMES, GRAM = 6, 4, 5
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
REPORT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")
ROWS = 256  # texts taken from a batch at a time


class LastOccurrences:
    """Splay trees over the states of an automaton: one for each path of equal last occurrence, keyed by depth.

    State 0, the root, is in no tree. The last occurrence of a path is kept at the root of its splay tree, whose parent, if
    any, is the state above the path.
    """

    def __init__(self) -> None:
        self.left, self.right, self.parent, self.last = [0], [0], [0], [-1]

    def add(self) -> None:
        for column, value in ((self.left, 0), (self.right, 0), (self.parent, 0), (self.last, -1)):
            column.append(value)

    def splay(self, x: int) -> None:
        left, right, parent, last = self.left, self.right, self.parent, self.last
        while True:
            p = parent[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = parent[p]
            if g and (left[g] == p or right[g] == p):
                turns = (p, x) if (left[g] == p) == (left[p] == x) else (x, x)
            else:
                last[x] = last[p]
                turns = (x,)
            for y in turns:  # rotate y above its parent
                p = parent[y]
                g = parent[p]
                if g and left[g] == p:
                    left[g] = y
                elif g and right[g] == p:
                    right[g] = y
                else:
                    last[y] = last[p]
                if left[p] == y:
                    b = left[p] = right[y]
                    right[y] = p
                else:
                    b = right[p] = left[y]
                    left[y] = p
                if b:
                    parent[b] = p
                parent[p], parent[y] = y, g

    def insert_above(self, x: int, new: int) -> None:
        """`new` becomes the link of x, on the same path: what is linked to it was last seen where x was."""
        self.splay(x)
        above = self.left[x]
        self.left[new] = above
        if above:
            self.parent[above] = new
        self.left[x] = new
        self.parent[new] = x

    def access(self, x: int, link: int, end: int, length: list[int]) -> Iterator[tuple[int, int, int]]:
        """Makes the root path of the new state x, linked to `link`, one path last seen at `end`.

        Yields for each segment that was there the length above it, its deepest state's length, and where it was last seen.
        """
        left, right, parent, last = self.left, self.right, self.parent, self.last
        below, y = x, link
        parent[x] = link
        while y:
            self.splay(y)
            seen, above = last[y], parent[y]
            yield length[above], length[y], seen
            if right[y]:
                last[right[y]] = seen
            right[y], parent[below] = below, y
            below, y = y, above
        last[below] = end


def squares_to_runs(words: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least twice their period, in no order."""
    paths, after, link, length = LastOccurrences(), [{}], [-1], [0]
    found: dict[tuple[int, int], int] = {}

    def state(of: int, steps: dict, to: int) -> int:
        paths.add()
        after.append(steps)
        link.append(to)
        length.append(of)
        return len(length) - 1

    tip = 0
    for i, word in enumerate(words):
        new, p = state(length[tip] + 1, {}, 0), tip
        while p >= 0 and word not in after[p]:
            after[p][word] = new
            p = link[p]
        if p >= 0:
            q = after[p][word]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = state(length[p] + 1, dict(after[q]), link[q])
                while p >= 0 and after[p].get(word) == q:
                    after[p][word] = copy
                    p = link[p]
                paths.insert_above(q, copy)
                link[q] = link[new] = copy
        tip = new
        for above, common, seen in paths.access(new, link[new], i, length):
            distance = i - seen
            if above < distance <= common:
                found[i - common - distance + 1, distance] = i
    return [(start, end - start + 1, period) for (start, period), end in found.items()]


def stretches(words: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of the stretches of words that may hold runs; words as 64-bit hashes."""
    n = len(words) - GRAM + 1
    if n < 2:
        return []
    grams = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        grams = (grams * np.uint64(0x9E3779B97F4A7C15)) ^ (words[k : k + n] + np.uint64(k))
    order = np.argsort(grams, kind="stable")
    equal = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    if not len(equal):
        return []
    away = np.full(n, 4 * n + 4 * GRAM, dtype=np.int64)
    apart = order[equal + 1] - order[equal]
    np.minimum.at(away, order[equal], apart)
    np.minimum.at(away, order[equal + 1], apart)
    held = TIMES * away <= len(words)
    while True:
        edges = np.diff(np.concatenate([[0], held.view(np.int8), [0]]))
        first, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        size = end - first + GRAM - 1
        at = np.flatnonzero(held)
        far = TIMES * away[at] > np.repeat(size, end - first)
        if not far.any():
            return [(int(a), int(a + s)) for a, s in zip(first, size, strict=True) if s >= LEAST]
        held[at[far]] = False


def find_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of a text's runs, by start and then period."""
    found = []
    for first, end in stretches(np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)):
        numbers: dict[bytes, int] = {}
        for start, length, period in squares_to_runs([numbers.setdefault(w, len(numbers)) for w in words[first:end]]):
            if length >= max(LEAST, TIMES * period):
                found.append((first + start, length, period))
    return sorted((s, n, q) for s, n, q in found)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept)]


def split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()  # bytes split at \x20 and \x09-\x0D


def scan(docs: DataFrame, runs: str = "runs", text: str = "collapsed") -> DataFrame:
    """docs with their runs and the text without the repeats, words joined by one space."""
    kept = [c for c in docs.columns if c not in (runs, text)]
    whole = fresh_names(docs.columns, "text")[0]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            all_words = [split(t) for t in batch.column(whole).to_pylist()]
            found = [find_runs(w) for w in all_words]
            spans = [[{"start": s, "length": n, "period": q} for s, n, q in f] for f in found]
            texts = [b" ".join(collapsed(w, f)).decode("utf-8", "surrogatepass") for w, f in zip(all_words, found, strict=True)]
            struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(spans, pa.list_(struct)), pa.array(texts, pa.string())],
                                             names=[*kept, runs, text])

    schema = docs.select(*kept).sparkSession.createDataFrame([], f"`{runs}` {RUNS}, `{text}` string").schema
    out = docs.select(*kept).schema
    for field in schema:
        out = out.add(field)
    return docs.select(*kept, F.col("text").cast("string").alias(whole)).mapInArrow(add, out)


def made_periodic(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words that the report looks at: of every tenth document by hashed id, the rest from a hashed place on is periodic.

    Documents without an id stay as they are.
    """
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * ((n - a) // p + 1))[: n - a]


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run, runs_sha256 and collapsed_sha256 per document, after made_periodic."""

    def judge(doc_id: int | None, text: str | None) -> tuple:
        words = made_periodic(doc_id, split(text))
        runs = find_runs(words)
        start, length, period = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
        return (doc_id, len(runs), start, length, period, 1000 * length // period if runs else None,
                hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            rows = [judge(*r) for r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            columns = zip(*rows, strict=True)
            types = [*[pa.int64()] * 6, *[pa.string()] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=[c.split()[0] for c in REPORT.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(add, REPORT)
