"""Conversation structure repair by depth-first branch-and-bound.

A conversation's roles should spell `(s?(ua)+)?`: an optional system turn, then user and assistant in turn. Edits: Keep costs 0, Rerole
to user or assistant 1, Delete 2 (required for blank and duplicate rows), Insert an empty user or assistant turn 5; a truncated row that
is not deleted adds 5. The repair is the cheapest list of edits, of equal ones the ASCII-least string of initials (the audit). What an
audit leaves has fixed roles, since the place of a turn decides its role, so an audit names one result.

Search (`repaired`): nodes are (rows done, state of the roles). An explicit stack holds partial edits; a suffix lower bound, the least cost
of the remaining rows from each state whatever the audit is, orders and prunes them; the incumbent is the best (cost, audit) so far; a
table for each node keeps the best (cost, audit) that reached it and cuts worse prefixes. Two audits of one node and cost are never one the
beginning of the other (what follows would be inserts, which cost), so the lesser prefix stays the lesser. The stack's end proves optimality.

Layout: rows are laid out by range of (conversation, turn, role, digest), so that a conversation of any size is spread over tasks. A task cuts
what it holds of a conversation into blocks of at most `BLOCK` rows. A conversation within one block is solved at once; a block of a longer one
is solved from each state to each state, and blocks are put together 64 at a time, which is exact by the same argument. What a conversation has in
one place at last is its audit, which is a value of the result, and its text runs past one hash, row by row.

Rows of one turn are ordered by role, then by a 128-bit digest of the text; equal rows are adjacent. Null role and text count as one space, a
null conv_id is a conversation of its own, null turns come first. A row with an empty role must be reroled or deleted. Empty tables give empty
results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from givingledger.llm.common import written

BLOCK = 4096
MERGED = 64
CACHED = 100_000
NEEDED = "uuau"  # role that the next turn must have: at the start, after system, after user, after assistant
NEXT = (2, 2, 3, 2)  # state after such a turn
ENDS = (0, 3)
KEEP, REROLE, DELETE, INSERT = ("K", 0), ("R", 1), ("D", 2), ("I", 5)
TRUNCATED = 5
NEVER = 1 << 60
BLANKS = " \t\n\x0b\f\r"

Best = tuple[int, str]


# --- branch-and-bound over symbols: b blank, d duplicate; s, u, a, x (another role), in capitals where truncated


def edits(symbol: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits of one row."""
    yield *DELETE, state
    if symbol in "bd":
        return
    role, more = symbol.lower(), TRUNCATED * symbol.isupper()
    if role == NEEDED[state]:
        yield KEEP[0], KEEP[1] + more, NEXT[state]
    elif role == "s" and state == 0:
        yield KEEP[0], KEEP[1] + more, 1
    yield REROLE[0], REROLE[1] + more, NEXT[state]


EDITS = {(symbol, state): tuple(edits(symbol, state)) for symbol in "bdsuaxSUAX" for state in range(4)}


def suffix_bounds(symbols: str, ends: tuple[int, ...]) -> list[list[int]]:
    """bounds[i][state]: no way from there to one of the ends costs less."""

    def with_inserts(costs: list[int]) -> list[int]:
        for state in (2, 3, 2, 0, 1):
            costs[state] = min(costs[state], INSERT[1] + costs[NEXT[state]])
        return costs

    bounds = [with_inserts([0 if state in ends else NEVER for state in range(4)])]
    for symbol in reversed(symbols):
        rest = bounds[-1]
        bounds.append(with_inserts([min(cost + rest[to] for _, cost, to in EDITS[symbol, state]) for state in range(4)]))
    return bounds[::-1]


def repaired(symbols: str, start: int = 0, ends: tuple[int, ...] = ENDS) -> Best | None:
    """The least (cost, audit) from state `start` to one of `ends`; None if there is no way."""
    bounds, n = suffix_bounds(symbols, ends), len(symbols)
    if bounds[0][start] >= NEVER:
        return None
    incumbent: Best | None = None
    reached: dict[tuple[int, int], Best] = {}
    stack = [(0, start, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if incumbent and (cost + bounds[i][state], audit) > (incumbent[0], incumbent[1][: len(audit)]):
            continue
        if (i, state) in reached and reached[i, state] <= (cost, audit):
            continue
        reached[i, state] = cost, audit
        if i == n and state in ends and (incumbent is None or (cost, audit) < incumbent):
            incumbent = cost, audit
        further = [(i, NEXT[state], cost + INSERT[1], audit + INSERT[0])]
        if i < n:
            further += [(i + 1, to, cost + more, audit + letter) for letter, more, to in EDITS[symbols[i], state]]
        promising = [(c + bounds[j][to], a, (j, to, c, a)) for j, to, c, a in further if c + bounds[j][to] < NEVER]
        stack += [node for _, _, node in sorted(promising, reverse=True)]  # the best bound is taken first
    return incumbent


def block_table(symbols: str) -> list[dict]:
    """The best edits of a block from each state to each state."""
    found = ((a, b, repaired(symbols, a, (b,))) for a in range(4) for b in range(4))
    return [{"start": a, "end": b, "cost": best[0], "audit": best[1]} for a, b, best in found if best]


def joined_tables(tables: list[list[dict]]) -> list[dict]:
    """The table of consecutive blocks."""
    out = []
    for start in range(4):
        held: dict[int, Best] = {start: (0, "")}
        for table in tables:
            reach: dict[int, Best] = {}
            for e in table:
                if e["start"] in held:
                    cost, audit = held[e["start"]]
                    best = cost + e["cost"], audit + e["audit"]
                    reach[e["end"]] = min(best, reach.get(e["end"], best))
            held = reach
        out += [{"start": start, "end": end, "cost": cost, "audit": audit} for end, (cost, audit) in held.items()]
    return out


def best_of(table: list[dict]) -> Best:
    return min((e["cost"], e["audit"]) for e in table if e["start"] == 0 and e["end"] in ENDS)


# --- rows


KEY = ["named", "conv"]  # of a conv_id; null comes first
ORDER = [*KEY, "dated", "turn", "role", "hi", "lo"]


def keyed(conversations: DataFrame) -> DataFrame:
    """(named, conv, dated, turn, role, text, copies): plain rows, each once."""
    return conversations.select(
        F.col("conv_id").isNotNull().alias("named"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("turn").isNotNull().alias("dated"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], F.lit(1).alias("copies"))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after the damage that crc32 of `conv_id:turn` decides."""
    spelled = [F.when(F.col(known), F.col(c).cast("string")).otherwise(" ") for known, c in (("named", "conv"), ("dated", "turn"))]
    kind = F.crc32(F.encode(F.concat(spelled[0], F.lit(":"), spelled[1]), "UTF-8")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    return rows.filter(kind != 0).select(
        *KEY, "dated", "turn", role.alias("role"), text.alias("text"), F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"))


def digested(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"hi": F.xxhash64(F.lit(1), "text"), "lo": F.xxhash64(F.lit(2), F.length("text"), "text")})


def symbols_of(rows: DataFrame) -> DataFrame:
    """(*ORDER, symbol, initial) of each copy of each row, without texts. `initial`: code point of the role's first character, 0 for none."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    whole = F.substring(trimmed, -1, 1).isin(".", "!", "?")
    narrow = digested(rows).withColumns({"blank": (trimmed == "").cast("int"), "cut": (~whole).cast("int")})
    distinct = narrow.groupBy(*ORDER).agg(F.sum("copies").alias("n"), F.max("blank").alias("blank"), F.max("cut").alias("cut"))
    distinct = written(distinct, "turns")
    same = [*KEY, "role", "hi", "lo"]
    # The first turn that has this role and text; a row without a turn comes before all others.
    firsts = distinct.groupBy(*same).agg(F.min("dated").alias("first_dated"), F.min(F.when(F.col("dated"), F.col("turn"))).alias("first_turn"))
    later = "copy > 1 OR dated != first_dated OR (dated AND turn != first_turn)"
    copies = distinct.join(firsts, same).withColumn("copy", F.explode(F.expr("sequence(1L, n)")))
    role = F.substring("role", 1, 1)
    plain = F.when(role.isin("s", "u", "a"), role).otherwise("x")
    symbol = F.when(F.col("blank") == 1, "b").when(F.expr(later), "d").when(F.col("cut") == 1, F.upper(plain)).otherwise(plain)
    return copies.select(*ORDER, "copy", F.ascii(symbol).alias("symbol"), F.when(role == "", 0).otherwise(F.ascii(role)).alias("initial"))


ENTRY = "array<struct<start:int,end:int,cost:bigint,audit:string>>"
BLOCKS = f"named boolean, conv long, part int, place int, symbols string, illegal long, head int, tail int, whole boolean, parts {ENTRY}"
ARROW_ENTRY = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
ARROW_BLOCKS = pa.schema([("named", pa.bool_()), ("conv", pa.int64()), ("part", pa.int32()), ("place", pa.int32()), ("symbols", pa.string()),
                          ("illegal", pa.int64()), ("head", pa.int32()), ("tail", pa.int32()), ("whole", pa.bool_()), ("parts", ARROW_ENTRY)])
LEGAL = np.array([a * 0x110000 + b for a, b in (map(ord, p) for p in ("su", "ua", "au"))], dtype=np.int64)


def illegal_pairs(initials: np.ndarray) -> int:
    return int((~np.isin(initials[:-1].astype(np.int64) * 0x110000 + initials[1:], LEGAL)).sum())


def blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """What each task holds of each conversation, in blocks; those that are not a whole conversation with a table; stored."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known, places = TaskContext.get().partitionId(), {}, 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        owner, n_held, first_of_part, begun = None, 0, True, False

        def block(last: bool, ends_part: bool = False) -> dict:
            """begun: the conversation has an earlier block in this task."""
            nonlocal held, n_held, places
            symbols = np.concatenate([h[0] for h in held]).astype(np.uint8).tobytes().decode()
            initials = np.concatenate([h[1] for h in held])
            whole = last and not (begun or first_of_part or ends_part)
            if whole:
                if symbols not in known:
                    if len(known) >= CACHED:
                        known.clear()
                    cost, audit = repaired(symbols)
                    known[symbols] = [{"start": 0, "end": 0, "cost": cost, "audit": audit}]
                table = known[symbols]
            else:
                table = block_table(symbols)
            held, n_held, places = [], 0, places + 1
            return dict(zip(ARROW_BLOCKS.names, (*owner, part, places, symbols, illegal_pairs(initials), int(initials[0]), int(initials[-1]), whole, table), strict=True))

        for batch in batches:
            if not batch.num_rows:
                continue
            named, conv, symbol, initial = (batch.column(c).to_numpy(zero_copy_only=False) for c in (*KEY, "symbol", "initial"))
            edges = np.flatnonzero((named[1:] != named[:-1]) | (conv[1:] != conv[:-1])) + 1
            out = []
            for a, b in zip([0, *edges], [*edges, len(conv)], strict=True):
                now = bool(named[a]), int(conv[a])
                if owner is not None and now != owner:
                    if n_held:
                        out.append(block(last=True))
                    first_of_part, begun = False, False
                owner = now
                while a < b:
                    if n_held == size:
                        out.append(block(last=False))
                        begun = True
                    step = min(b - a, size - n_held)
                    held.append((symbol[a : a + step], initial[a : a + step]))
                    a, n_held = a + step, n_held + step
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=ARROW_BLOCKS)
        if n_held:
            yield pa.RecordBatch.from_pylist([block(last=True, ends_part=True)], schema=ARROW_BLOCKS)

    full = [*ORDER, "copy"]
    laid = rows.repartitionByRange(*full).sortWithinPartitions(*full).select(*KEY, "symbol", "initial")
    return written(laid.mapInArrow(cut, BLOCKS), "blocks")


MERGE = "named boolean, conv long, seq long, blank long, duplicate long, truncated long, illegal long, head int, tail int, parts " + ENTRY


def merged(found: pd.DataFrame) -> pd.DataFrame:
    found = found.sort_values("seq")
    initials = np.array([x for pair in zip(found["head"], found["tail"], strict=True) for x in pair][1:-1], dtype=np.int64)
    between = sum(illegal_pairs(initials[i : i + 2]) for i in range(0, len(initials), 2))
    one = found.iloc[0]
    return pd.DataFrame([{
        "named": one["named"], "conv": one["conv"], "seq": one["seq"] // MERGED,
        **{c: int(found[c].sum()) for c in ("blank", "duplicate", "truncated")}, "illegal": int(found["illegal"].sum()) + between,
        "head": one["head"], "tail": found.iloc[-1]["tail"], "parts": joined_tables([list(t) for t in found["parts"]])}])


def counted() -> list[Column]:
    of = lambda letters, name: (F.length("symbols") - F.length(F.translate("symbols", letters, ""))).cast("long").alias(name)
    return [of("b", "blank"), of("d", "duplicate"), of("SUAX", "truncated")]


SOLVED = [*KEY, "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def solutions(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """SOLVED for each conversation that has rows; stored."""
    cut = blocks(symbols_of(rows), size)
    whole = cut.filter("whole").select(*KEY, *counted(), "illegal", *[F.col("parts")[0][c].alias(c) for c in ("cost", "audit")])
    seq = F.row_number().over(Window.partitionBy(*KEY).orderBy("part", "place")) - 1  # a row for each block
    parts = cut.filter("NOT whole").select(*KEY, seq.cast("long").alias("seq"), *counted(), "illegal", "head", "tail", "parts")
    while True:
        grouped = parts.withColumn("box", F.expr(f"seq DIV {MERGED}")).groupBy(*KEY, "box")
        parts = written(grouped.applyInPandas(merged, MERGE), "merged")
        if parts.filter("seq > 0").isEmpty():
            break
    table = F.filter("parts", lambda e: (e["start"] == 0) & e["end"].isin(*ENDS))
    best = F.array_min(F.transform(table, lambda e: F.struct(e["cost"].alias("cost"), e["audit"].alias("audit"))))
    rest = parts.withColumn("best", best).select(*SOLVED[:-2], "best.cost", "best.audit")
    return written(whole.unionByName(rest), "solutions")


def edited_rows(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """(named, conv, step, role, text): each conversation's turns after its audit, laid out by conversation in order."""
    return stream(rows, solved, "named boolean, conv long, step long, role string, text string", hashed=False)


def repaired_hashes(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """(named, conv, repaired_sha256) for each conversation with rows."""
    return stream(rows, solved, "named boolean, conv long, repaired_sha256 string", hashed=True)


class Reader:
    """Takes a conversation's rows in order and gives its turns after the audit."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == INSERT[0]:
            yield self.made(""), ""
            self.at += 1

    def made(self, role: str) -> str:
        """The role of the next turn, which is `role` itself if it is given."""
        if role:
            self.state = {"s": 1, "u": 2, "a": 3}[role[0]]
            return role
        wanted = {"u": "user", "a": "assistant"}[NEEDED[self.state]]
        self.state = NEXT[self.state]
        return wanted

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter != DELETE[0]:
            yield self.made(role if letter == KEEP[0] else ""), text


def stream(rows: DataFrame, solved: DataFrame, schema: str, hashed: bool) -> DataFrame:
    """One conversation after the other; in memory are its audit, a hash, and a batch of rows."""
    names = [c.split()[0] for c in schema.split(", ")]
    types = pa.schema([(n, {"named": pa.bool_(), "conv": pa.int64(), "step": pa.int64()}.get(n, pa.string())) for n in names])

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, reader, digest, step, out = None, None, None, 0, []

        def take(turns: Iterator[tuple[str, str]]) -> None:
            nonlocal step
            for role, text in turns:
                if hashed:
                    digest.update(f"{chr(10) if step else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                else:
                    out.append((*owner, step, role, text))
                step += 1

        def close() -> None:
            take(reader.inserted())
            if hashed:
                out.append((*owner, digest.hexdigest()))

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=types)
            out.clear()
            return made

        for batch in batches:
            for named, conv, kind, role, text in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if kind == 0:
                    if owner is not None:
                        close()
                    owner, reader, digest, step = (named, conv), Reader(text), hashlib.sha256(), 0
                else:
                    take(reader.row(role, text))
            yield batch_of()
        if owner is not None:
            close()
        yield batch_of()

    texts = digested(rows).select(*ORDER, "text", F.lit(1).alias("kind"), F.explode(F.expr("sequence(1, copies)")).alias("copy"))
    audits = solved.select(
        *KEY, F.lit(False).alias("dated"), F.lit(0).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(0).cast("long").alias("hi"),
        F.lit(0).cast("long").alias("lo"), F.col("audit").alias("text"), F.lit(0).alias("kind"), F.lit(1).alias("copy"))
    every = texts.unionByName(audits).drop("copy").repartition(*KEY).sortWithinPartitions(*KEY, "kind", *ORDER[2:])
    return every.select(*KEY, "kind", "role", "text").mapInArrow(edit, schema)


def repair(conversations: DataFrame, size: int = BLOCK) -> DataFrame:
    """(conv_id, step, role, text): the turns of every conversation after its cheapest repair, numbered from 0."""
    rows = keyed(conversations)
    return edited_rows(rows, solutions(rows, size)).select(F.when(F.col("named"), F.col("conv")).alias("conv_id"), "step", "role", "text")


def report(conversations: DataFrame, size: int = BLOCK) -> DataFrame:
    """Per original conv_id, after the damage: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    original = keyed(conversations)
    rows = damaged(original)
    solved = solutions(rows, size)
    turns = rows.filter("dated").select(*KEY, "turn").distinct().groupBy(*KEY).agg(
        (F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    joined = original.select(*KEY).distinct().join(turns, KEY, "left").join(solved, KEY, "left").join(repaired_hashes(rows, solved), KEY, "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256(b"").hexdigest()
    return joined.select(F.when(F.col("named"), F.col("conv")).alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
