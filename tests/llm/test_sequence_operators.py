"""Fingerprints, conversation repair and periodic runs against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import struct
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import pytest
import xxhash
from conftest import PUNCTUATED, SPACED, lowered  # noqa: F401
from pyspark.sql import functions as F

from givingledger.llm import conversations, fingerprints, periodic_runs
from givingledger.llm.common import PUNCTUATION, lower_ascii, split_words
from givingledger.llm.queries import llm_queries

FOLDER = "/root/testdata/sf0.001"


def bag(rows):
    return Counter(map(repr, rows))


# --- fingerprints


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def term_hash(word: str) -> int:
    return signed(xxhash.xxh64_intdigest(word.encode(), seed=42))


def member(term: int, k: int) -> bool:
    """Whether subset k holds a term: hashes chained as Spark chains them."""
    first = xxhash.xxh64_intdigest(struct.pack("<i", k), seed=xxhash.xxh64_intdigest(struct.pack("<q", term), seed=42))
    return first >> 1 <= min(int(0.86**k * 2.0**63), 2**63 - 1)


def expected_fingerprints(rows, low=1 / 4096, high=1 / 16, buckets=1 << 20):
    """rows (doc_id, text) with distinct ids: what the report says, without the spelled fingerprints."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    words = lambda text: {term_hash(w) for w in PUNCTUATED.findall(lowered(text))}
    counts = Counter(b for _, t in rows for b in {h % buckets for h in words(t)})
    lexicon = {b for b, n in counts.items() if max(2, len(rows) * low) <= n <= max(2, len(rows) * high)}

    @lru_cache(maxsize=None)
    def subsets(text):
        held = words(text)
        held = {h for h in held if h % buckets in lexicon} or held or {term_hash(text)}
        return [frozenset(h for h in held if member(h, k)) for k in range(48)]

    def near(a, b):
        pairs = [(x, y) for x, y in zip(subsets(a), subsets(b), strict=True) if x or y]
        return sum(x == y for x, y in pairs[-16:]) / len(pairs[-16:])

    out = []
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), near(text, edited), near(text, following)))
    return out


REPORT11 = ("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next")


def test_fingerprints_of_the_sample(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = fingerprints.edited_report(docs).collect()
    expected = expected_fingerprints([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert bag(tuple(r[c] for c in REPORT11) for r in found) == bag(expected)
    assert all(len(r.fingerprint) == 48 * 8 and re.fullmatch("([0-9a-f]{8}|-{8})+", r.edited_fingerprint) for r in found)
    texts = {r.doc_id: r.text for r in docs.collect()}
    by_text = defaultdict(set)
    for r in found:
        by_text[texts[r.doc_id]].add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values()) and len(by_text) < len(texts)


def test_edits_are_told_from_other_texts(spark):
    found = fingerprints.edited_report(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).select("near_edited", "near_next", "n_chars").collect()
    closer = sum(r.near_edited > r.near_next or r.near_edited == 1 for r in found)
    print(closer, len(found), sum(r.near_edited for r in found) / len(found), sum(r.near_next for r in found) / len(found))
    assert closer >= 0.97 * len(found)


def test_fingerprint_edge_cases(spark, docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = fingerprints.edited_report(docs).collect()
    assert sorted((r.doc_id or 0) for r in found) == sorted((i or 0) for i, _ in rows)  # repeated rows stay
    assert bag(tuple(r[c] for c in REPORT11) for r in found if r.doc_id != 9) == bag(
        e for e in expected_fingerprints(rows[:], high=1 / 16) if e[0] != 9)
    assert [r.near_edited for r in found if r.n_chars < 4] == [1.0] * sum(len(t or "") < 4 for _, t in rows)
    assert fingerprints.edited_report(no_docs).collect() == []
    alone = fingerprints.edited_report(docs.filter("doc_id = 8")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    kept = fingerprints.fingerprinted(docs.withColumn("hashes", F.lit(1)).withColumn("fingerprint", F.lit("old")))
    assert kept.columns == [*docs.columns, "hashes", "fingerprint"] and kept.filter("fingerprint = 'old'").isEmpty()


def test_one_id_with_several_texts_has_one_next_document(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (1, "p q r s t u v w"), (2, "x1 x2 x3"), (2, "x1 x2 x3"), (2, "y1 y2 y3"), (3, "z z")], "doc_id long, text string")
    found = fingerprints.edited_report(docs).collect()
    assert len(found) == 6
    heads = {"x1 x2 x3", "y1 y2 y3"}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    options = [{sha(t[:12] + h[:3]) for t in ("a b c d e f g h", "p q r s t u v w")} for h in heads]
    assert {r.edited_sha256 for r in found if r.doc_id == 1} in options


def test_fingerprints_use_built_in_functions_only(spark):
    plan = fingerprints.edited_report(spark.read.parquet(f"{FOLDER}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fingerprints_sort_and_lower_without_lambdas(spark):
    """Terms are sorted as numbers, ASCII texts lowered as a whole; other texts keep letters beyond A-Z, as before."""
    texts = ["B a B c", "\u00c4B \u0130X \u212aelvin ab", "", "ZZ-top \x00 Q[x]"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = df.select("text", fingerprints.terms(F.col("text")).alias("found"), F.array_sort(F.array_distinct(F.transform(
        split_words(lower_ascii(F.col("text")), PUNCTUATION), lambda w: F.xxhash64(w)))).alias("expected")).collect()
    assert len(rows) == 4 and all(sorted(r.found) == r.expected for r in rows)
    plan = df.select(fingerprints.subset_hashes(F.col("text"), F.array(F.lit(-1).cast("long")), 64))._jdf.queryExecution().analyzed().toString()
    assert "sort_array(" in plan and "array_sort(" not in plan and "sequence(" not in plan


# --- conversation repair


GRAMMAR = re.compile(r"(s?(ua)+)?")


def exhaustive(symbols, inserts=2):
    """Every list of edits with at most `inserts` inserted turns between two rows."""
    best = None
    gaps = [g for n in range(inserts + 1) for g in itertools.product("ua", repeat=n)]
    rows = []
    for c in symbols:
        options = [("D", 2, "")]
        if c not in "bd":
            more = 5 if c.isupper() else 0
            options += [("K", more, c.lower()), ("R", 1 + more, "u"), ("R", 1 + more, "a")]
        rows.append(options)
    for filled in itertools.product(gaps, repeat=len(symbols) + 1):
        cost = 5 * sum(map(len, filled))
        if best and cost > best[0]:
            continue
        for chosen in itertools.product(*rows):
            spelled = "".join("".join(g) + e[2] for g, e in zip(filled, [*chosen, ("", 0, "")], strict=True))
            if GRAMMAR.fullmatch(spelled):
                audit = "".join("I" * len(g) + e[0] for g, e in zip(filled, [*chosen, ("", 0, "")], strict=True))
                found = cost + sum(e[1] for e in chosen), audit
                best = min(best or found, found)
    return best


def by_states(symbols):
    """The same for longer lists: best (cost, audit) per (row, state), row by row."""
    held = {0: (0, "")}

    def inserted(held):
        for _ in range(3):
            for q, (c, a) in list(held.items()):
                to = {0: 2, 1: 2, 2: 3, 3: 2}[q]
                held[to] = min(held.get(to, (c + 5, a + "I")), (c + 5, a + "I"))
        return held

    for s in symbols:
        now = {}
        for q, (c, a) in inserted(held).items():
            options = [(q, c + 2, a + "D")]
            if s not in "bd":
                more = 5 if s.isupper() else 0
                to = {0: 2, 1: 2, 2: 3, 3: 2}[q]
                options.append((to, c + 1 + more, a + "R"))
                if s.lower() == "uuau"[q]:
                    options.append((to, c + more, a + "K"))
                if s.lower() == "s" and q == 0:
                    options.append((1, c + more, a + "K"))
            for to, cost, audit in options:
                now[to] = min(now.get(to, (cost, audit)), (cost, audit))
        held = now
    return min(v for q, v in inserted(held).items() if q in (0, 3))


def test_search_finds_the_cheapest_edits():
    for n in range(4):
        for symbols in itertools.product("bsuaxSUAX", repeat=n):
            assert conversations.repaired("".join(symbols)) == exhaustive(symbols), symbols
    random.seed(4)
    for _ in range(400):
        symbols = "".join(random.choice("bdsuuuaaaxSUAX") for _ in range(random.randrange(40)))
        assert conversations.repaired(symbols) == by_states(symbols)
        cuts = sorted(random.sample(range(len(symbols) + 1), min(3, len(symbols) + 1)))
        pieces = [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)], strict=True)]
        assert conversations.best_of(conversations.joined_tables([conversations.block_table(p) for p in pieces])) == by_states(symbols)


def test_search_is_linear_in_the_rows():
    cost, audit = conversations.repaired("uuaaxU" * 1500)
    assert len(audit) >= 9000 and cost > 0


def expected_repair(rows, damage=True):
    """rows (conv_id, turn, role, text)."""
    found = {c: [] for c, *_ in rows}
    digest = lambda t: signed(xxhash.xxh64_intdigest(t.encode(), seed=xxhash.xxh64_intdigest(struct.pack("<i", 1), seed=42)))
    sp = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        role, text = sp(role), sp(text)
        kind = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20 if damage else 9
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        found[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, turns in found.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r[2])))
        numbers = [t for t, _, _ in turns if t is not None]
        symbols, seen = "", set()
        for _, role, text in turns:
            plain = text.strip(" \t\n\x0b\f\r")
            s = "b" if not plain else "d" if (role, text) in seen else role[:1] if role[:1] and role[0] in "sua" else "x"
            symbols += s.upper() if plain and s not in "bd" and plain[-1] not in ".!?" else s
            seen.add((role, text))
        cost, audit = by_states(symbols)
        made, left, state = [], iter(turns), 0
        for letter in audit:
            turn = None if letter == "I" else next(left)
            if letter == "D":
                continue
            role = turn[1] if letter == "K" else ["user", "user", "assistant", "user"][state]
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            made.append(f"{role}:{turn[2] if turn else ''}")
        initials = [r[:1] for _, r, _ in turns]
        out.append((conv, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, symbols.count("b"), symbols.count("d"),
                    sum(c.isupper() for c in symbols), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
                    cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return out


def conversation_rows(spark, folder):
    return spark.read.parquet(f"{folder}/conversations.parquet")


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_repair_of_the_sample(spark, folder):
    rows = conversation_rows(spark, folder)
    expected = expected_repair([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])
    assert bag(tuple(r) for r in llm_queries()["op12_conversation_repair"](spark, folder).collect()) == bag(expected)


CONVERSATION = "conv_id long, turn long, role string, text string, symbols string, part int, audit string"


def edge_conversations(spark):
    random.seed(8)
    rows = [(1, None, None, None), (1, None, "user", "A?"), (1, 0, "", "x."), (1, 5, "assistant", "Yes.  \n"), (2, 7, "user", ""),
            (None, 1, "user", "no id."), (None, 2, "assistant", "No id!"), (None, None, "assistant", "no id"), (3, 1, "tool", "t."), (3, 1, "tool", "t."),
            (3, 1, "Δelta", "ü."), (4, 2**62, "user", "big."), (4, -5, "system", "low."), (5, 3, "user", "a.\nb:c."), (6, 0, "s", "k" * 300_000)]
    rows += [(100, t, random.choice(["user", "assistant", "user", "assistant", "system", "other"]), random.choice(["a.", "b!", "c", "", f"t{t}."]))
             for t in range(700)]
    rows += [(101, 5, "user", "same.")] * 90 + [(101, 6, "assistant", "same.")] * 3
    random.shuffle(rows)
    return rows, spark.createDataFrame([(*r, "c", 1, "c") for r in rows], CONVERSATION).repartition(5)


@pytest.mark.parametrize("size", [16, 4096])
def test_repair_edge_cases(spark, size):
    """Long conversations in several blocks and tasks, null keys, repeated rows, empty roles, clashing names."""
    rows, table = edge_conversations(spark)
    assert bag(tuple(r) for r in conversations.report(table, size).collect()) == bag(expected_repair(rows))


def test_repaired_turns(spark):
    rows, table = edge_conversations(spark)
    found = defaultdict(list)
    for r in sorted(conversations.repair(table, 16).collect(), key=lambda r: r.step):
        found[r.conv_id].append(f"{r.role}:{r.text}")
    for conv, *_, digest in expected_repair(rows, damage=False):
        assert hashlib.sha256("\n".join(found[conv]).encode()).hexdigest() == digest
        assert GRAMMAR.fullmatch("".join(t[0] for t in found[conv]))
    assert conversations.report(table.limit(0)).collect() == [] and conversations.repair(table.limit(0)).collect() == []


# --- periodic runs


def brute_runs(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            run = words[i : j + q]
            if len(run) >= max(6, 4 * q) and not any(run[r:] == run[:-r] for r in range(1, q)):
                found.append((i, len(run), q))
            i = j
    return sorted(found)


def expected_runs(rows):
    out = []
    for doc_id, text in rows:
        words = SPACED.findall(text or "")
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        out.append((doc_id, len(runs), s, n, q, 1000 * n // q if runs else None,
                    hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2]))).encode()).hexdigest(),
                    hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_runs_against_brute_force():
    random.seed(1)
    for _ in range(3000):
        words = [random.choice("abcd"[: random.randint(1, 4)]).encode() for _ in range(random.randrange(60))]
        if words and random.random() < 0.6:
            a, p = random.randrange(len(words)), random.randint(1, 8)
            words = [w if i < a else words[min(a + (i - a) % p, len(words) - 1)] for i, w in enumerate(words)]
            words += [random.choice("abcd").encode() for _ in range(random.randrange(30))]
        assert periodic_runs.find_runs(words) == brute_runs(words)
        assert sorted(r for r in periodic_runs.squares_to_runs(list(map(ord, words))) if r[1] >= max(6, 4 * r[2])) == brute_runs(words)


def test_runs_of_the_sample(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect() if len(r.text) < 20_000]
    short = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in periodic_runs.report(short).collect()]
    assert bag(found) == bag(expected_runs(rows)) and sum(r[1] > 0 for r in found) > 10


def test_runs_edge_cases(spark, docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 20_000]
    small = docs.filter("coalesce(length(text), 0) < 20000")
    assert bag(map(tuple, periodic_runs.report(small).collect())) == bag(expected_runs(rows))
    assert periodic_runs.report(no_docs).collect() == []
    long = " ".join(["x"] * 200_000)
    named = spark.createDataFrame([(1, "a a a a a a a b", "r", 2, "t"), (2, None, "r", 2, "t"), (3, long, "r", 2, "t"), (3, long, "r", 2, "t")],
                                  "doc_id long, text string, runs string, _text int, Text2 string")
    kept = {(r.doc_id, r.collapsed, r._text, tuple(map(tuple, r.runs))) for r in periodic_runs.scan(named).collect()}
    assert kept == {(1, "a b", 2, ((0, 7, 1),)), (2, "", 2, ()), (3, "x", 2, ((0, 200_000, 1),))}
    assert periodic_runs.scan(named).columns == ["doc_id", "text", "_text", "Text2", "runs", "collapsed"]
