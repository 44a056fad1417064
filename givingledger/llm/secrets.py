"""Secret scans with a trigram inverted index.

From each rule's regular expression follows a Boolean query over the trigrams (of text with A-Z lowered) that every match
must hold. The index stores, for the trigrams that any query names, the documents that hold them; a document's postings meet
by grouping, and the query picks candidates, which alone are searched with the rule. A rule without mandatory trigrams is
searched in every text.

Spans are in code points, end exclusive; of one kind they don't overlap, of different kinds they may. Null text counts as
empty: no spans. A document's key is its doc_id with a hash of its text; repeated rows get repeated results. Candidates are
broadcast only if they are counted to be at most MAX_BROADCAST, else joined by shuffle. Very long texts are searched whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from givingledger.llm.common import fresh_names, slices, written
from givingledger.llm.shingles import blocks

MAX_BROADCAST = 1_000_000
MOST_STRINGS = 16
SPANS = "array<struct<start:bigint,stop:bigint,kind:string>>"
ROWS = 500

# The three base rules, in their order.
BASE = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
# A private key: to its END line; where the next such line is another's or none comes, over the base64 that follows, in lines or
# in words, quoted or with escaped line ends, with the fields before it. Possessive, so that a header without END costs one pass.
GAP = r"""(?:[\s"'>|*\#,]|\\[nrt])*+"""
PEM = (
    r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END [A-Z ]{0,30}PRIVATE KEY-----"
    rf"|(?:{GAP}(?:Proc-Type|DEK-Info|Version|Comment): ?(?:[^\n\\])*+)*+(?:{GAP}[A-Za-z0-9+/]{{16,}}+={{0,2}})++"
    rf"(?:{GAP}[A-Za-z0-9+/]++(?:={{1,2}}|(?=[ \t\"',]*(?:[\r\n\\]|\Z))))?)?")
# Rules of this operator's own: known forms of keys.
MORE = {
    "google": r"AIza[0-9A-Za-z_-]{35}",
    "jwt": r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}",
    "pem": PEM,
    "repository": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "chat": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "payment": r"[rs]k_live_[0-9a-zA-Z]{24,}",
}
RULES = BASE | MORE


def valid(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match.group(2)) >= 6
    return len(match.group()) >= {"access": 20, "hex": 24}.get(kind, 1)


# --- queries: None (any text), a trigram, or ("and" | "or", parts)


def both(parts: list) -> tuple | str | None:
    parts = [p for p in parts if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else ("and", tuple(dict.fromkeys(parts)))


def either(parts: list) -> tuple | str | None:
    return None if not parts or any(p is None for p in parts) else parts[0] if len(parts) == 1 else ("or", tuple(dict.fromkeys(parts)))


def of_string(text: str) -> tuple | str | None:
    return both([text[i : i + 3] for i in range(len(text) - 2)])


def strings(node: tuple) -> set[str] | None:
    """The few lower-case strings that a part of an expression can match, or None."""
    op, value = node
    if op is sre.LITERAL:
        return {chr(value).lower()} if value < 128 else None
    if op is sre.IN and all(k is sre.LITERAL and v < 128 for k, v in value) and len(value) <= 8:
        return {chr(v).lower() for _, v in value}
    if op is sre.SUBPATTERN:
        return sequence_strings(value[3])
    if op is sre.BRANCH:
        found = [sequence_strings(x) for x in value[1]]
        return None if any(x is None for x in found) else set().union(*found)
    if op is sre.MAX_REPEAT and value[1] <= 1:
        found = sequence_strings(value[2])
        return None if found is None else found | {""} if value[0] == 0 else found
    return None


def sequence_strings(nodes: list) -> set[str] | None:
    found = {""}
    for node in nodes:
        more = strings(node)
        if more is None or len(found) * len(more) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in more}
    return found


def sequence_query(nodes: list) -> tuple | str | None:
    """Of neighbouring parts with few strings their joined strings count; other parts count by themselves."""
    parts, held = [], {""}
    for node in [*nodes, None]:
        more = strings(node) if node else None
        if more is not None and len(held) * len(more) <= MOST_STRINGS:
            held = {a + b for a in held for b in more}
            continue
        parts.append(either([of_string(x) for x in sorted(held)]))
        held = more or {""}
        if node and more is None:
            op, value = node
            if op is sre.SUBPATTERN:
                parts.append(sequence_query(value[3]))
            elif op is sre.BRANCH:
                parts.append(either([sequence_query(x) for x in value[1]]))
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] >= 1:
                parts.append(sequence_query(value[2]))
    return both(parts)


def trigram_query(pattern: str) -> tuple | str | None:
    return sequence_query(list(sre_parser.parse(pattern)))


def trigrams_of(query: tuple | str | None) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def holds(query: tuple | str, places: dict[str, int]) -> Column:
    """Whether the array `held` of trigram numbers meets a query."""
    if isinstance(query, str):
        return F.array_contains("held", places[query])
    found = [holds(part, places) for part in query[1]]
    column = found[0]
    for more in found[1:]:
        column = column & more if query[0] == "and" else column | more
    return column


# --- index, candidates, spans


def document_key() -> Column:
    return F.struct("doc_id", F.xxhash64("text").alias("hash"))


def build_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, key): which documents (key, text) hold each of the trigrams, by number; stored."""
    codes = np.array([int.from_bytes(t.encode(), "big") for t in trigrams], dtype=np.int64)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.full(1 << 24, -1, dtype=np.int16)
        number[codes] = np.arange(len(codes))
        lower = np.arange(256, dtype=np.int32)
        lower[65:91] += 32
        for batch in batches:
            keys = batch.column("key")
            for row, data, ends in blocks(batch.column("text")):
                letters = lower[data]
                found = number[(letters[:-2] << 16) | (letters[1:-1] << 8) | letters[2:]] if len(data) > 2 else np.zeros(0, np.int16)
                at = np.flatnonzero(found >= 0)
                owner = np.searchsorted(ends, at, side="right")
                inside = owner == np.searchsorted(ends, at + 2, side="right")
                pairs = np.unique(owner[inside] * len(codes) + found[at[inside]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array((pairs % len(codes)).astype(np.int32)), keys.take(pa.array(row + pairs // len(codes)))], names=["trigram", "key"])

    schema = "trigram int, key struct<doc_id:" + docs.schema["key"].dataType["doc_id"].dataType.simpleString() + ",hash:bigint>"
    return written(docs.select("key", "text").mapInArrow(post, schema), "trigrams")


def candidates(docs: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(key, rules): the rules with mandatory trigrams whose query a document's postings meet."""
    queries = {kind: q for kind, pattern in rules.items() if (q := trigram_query(pattern)) is not None}
    names = sorted(set().union(*map(trigrams_of, queries.values())))
    places = {t: i for i, t in enumerate(names)}
    held = build_index(docs, names).groupBy("key").agg(F.collect_set("trigram").alias("held"))
    met = F.filter(F.array(*[F.when(holds(q, places), F.lit(kind)) for kind, q in queries.items()]), lambda x: x.isNotNull())
    return held.select("key", met.alias("rules")).filter(F.size("rules") > 0)


def find_spans(text: str, kinds: list[str], patterns: dict[str, re.Pattern], order: dict[str, int]) -> list[tuple[int, int, str, int]]:
    found = [(m.start(), order[kind], kind, m.end()) for kind in kinds for m in patterns[kind].finditer(text) if valid(kind, m)]
    return sorted(found)


def with_rules(docs: DataFrame, rules: dict[str, str], name: str) -> DataFrame:
    """docs with the rules whose trigrams each text holds."""
    key, id_key = fresh_names([*docs.columns, name], "key", "rules_key")
    keyed = docs.withColumn(key, document_key())
    found = written(candidates(keyed.select(F.col(key).alias("key"), F.col("text").cast("string")), rules), "candidates")
    found = found.select(F.col("key").alias(id_key), F.col("rules").alias(name))
    small = found.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    return keyed.join(F.broadcast(found) if small else found, F.col(key).eqNullSafe(F.col(id_key)), "left").drop(key, id_key)


def searcher(rules: dict[str, str], give: Callable[[str | None, list], object], kind: str, arrow: pa.DataType) -> Callable:
    """A function of (text, rules that the text may meet); texts go into Python once, and what `give` makes of the spans comes back."""
    always = [name for name, pattern in rules.items() if trigram_query(pattern) is None]

    @F.arrow_udf(kind)
    def search(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        patterns = {name: re.compile(p, re.ASCII) for name, p in rules.items()}
        order = {name: i for i, name in enumerate(rules)}
        for batch in batches:
            parts = []
            for texts, held in slices([batch], ROWS):
                rows = [give(text, find_spans(text or "", [*always, *(kinds or [])], patterns, order))
                        for text, kinds in zip(texts.to_pylist(), held.to_pylist(), strict=True)]
                parts.append(pa.array(rows, arrow))
            yield pa.concat_arrays(parts)

    return search


def spans_of(text: str | None, found: list[tuple[int, int, str, int]]) -> list[dict]:
    return [{"start": s, "stop": e, "kind": k} for s, _, k, e in found]


def scan(docs: DataFrame, rules: dict[str, str] = RULES, spans: str = "_spans") -> DataFrame:
    """docs with `spans` (start, stop, kind), by start and then in the order of the rules."""
    columns = [c for c in docs.columns if c != spans]
    (held,) = fresh_names([*docs.columns, spans], "rules")
    search = searcher(rules, spans_of, SPANS, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string())])))
    found = with_rules(docs.select(*columns), rules, held)
    return found.select(*columns, search(F.col("text").cast("string"), F.col(held)).alias(spans))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans per document."""
    found = scan(docs.select("doc_id", F.col("text").cast("string")))
    of = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    base = F.filter("_spans", lambda s: s["kind"].isin(list(BASE)))
    counts = [F.expr(f"CAST(size(filter(_spans, s -> s.kind = '{kind}')) AS BIGINT) AS n_{kind}") for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(F.encode(of(base), "UTF-8"), 256).alias("base_sha256"), of(F.col("_spans")).alias("spans"))


def masked(text: str | None, spans: list[tuple[int, int, str, int]], mask: str) -> str | None:
    """The text with each stretch that spans cover replaced."""
    if not spans:
        return text
    parts, done = [], 0
    for start, _, _, stop in spans:
        if start >= done:
            parts += [text[done:start], mask]
        done = max(done, stop)
    return "".join([*parts, text[done:]])


def redacted(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """All documents, with secrets replaced by the mask and n_chars, where there is such a column, counted anew."""
    (held,) = fresh_names(docs.columns, "rules")
    replace = searcher(RULES, lambda text, found: masked(text, found, mask), "string", pa.string())
    clean = replace(F.col("text").cast("string"), F.col(held)).alias("text")
    found = with_rules(docs, RULES, held).select(*[clean if c == "text" else c for c in docs.columns])
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else found
