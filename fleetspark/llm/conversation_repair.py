"""Repair of conversations: the cheapest edits that leave ``system? (user assistant)+``, or nothing.

Every conversation is a lattice of nodes (rows read, what the repaired text ends with). Its edges are the edits: Keep (0),
Rerole to user or assistant (3), Delete (4), Insert an empty user or assistant turn (3); keeping or reroling a truncated
row costs 3 more, blank and repeated rows can only be deleted. ``cheapest`` searches it from both ends
(bidirectional Dijkstra): the heaps meet, every crossing that can still cost as little is finished, and
the least of their concatenated audits (initials of the edits in order) wins.

On Spark the rows are range-partitioned by conversation and turn, so a hot conversation is spread over many tasks. A conversation
inside one partition is repaired there. One that crosses a border, or has more than ``CHUNK_ROWS`` rows, is cut into chunks:
each gives, for every state it may start and end in, its cheapest edits; chaining these small tables per conversation gives the
whole result, since lattice paths concatenate. Only the digest of such a conversation, a SHA-256
chain, is read in order by one task, a chunk at a time.

Defined results: nulls in conversation, turn, role or text count as one space where their text matters; null
conversations are one conversation, null turns come first and are left out of ``gaps``. Rows of equal turn go by a hash of role and
text, equal rows are neighbours and all but the first are duplicates. An empty role has no initial and can only be reroled or deleted.
Extra columns are ignored, also those with clashing names; an empty table gives no rows. The audit and the
digest of a conversation are one row each, so a conversation's audit (one letter a row) must fit a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.llm.common import map_arrow, shared_table, ship_code

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows and text bytes of one chunk of a long conversation.
CHUNK_ROWS, CHUNK_TEXT = 1024, 4 << 20
#: What the repaired text ends with; a conversation starts with NOTHING and may end with NOTHING or ASSISTANT.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)                   # where an inserted or reroled turn leads
BEFORE = ((), (), (NOTHING, SYSTEM, ASSISTANT), (USER,))  # and where it comes from
_KEPT = {"s": (SYSTEM, (NOTHING,)), "u": (USER, BEFORE[USER]), "a": (ASSISTANT, BEFORE[ASSISTANT])}
_SPACE = b" \t\n\x0b\x0c\r"
_COST = 1 << 40


def _moves(kind: str, forward: bool) -> list[list[tuple[int, int, str]]]:
    """Edits of one row by state: (other state, cost, letter); ``kind``: s u a x, upper case if truncated, or ``-``
    if it must go."""
    out = [[(state, DELETE, "D")] for state in range(4)]
    if kind == "-":
        return out
    extra = TRUNCATED if kind.isupper() else 0
    kept = _KEPT.get(kind.lower())
    for state in range(4):
        to = NEXT[state]
        keeps = kept is not None and state in kept[1]
        edits = ([(kept[0], KEEP + extra, "K")] if keeps else []) + ([] if keeps and kept[0] == to else [(to, REROLE + extra, "R")])
        for other, cost, letter in edits:
            out[state if forward else other].append((other if forward else state, cost, letter))
    return out


_FORWARD = {k: _moves(k, True) for k in "suaxSUAX-"}
_BACKWARD = {k: _moves(k, False) for k in "suaxSUAX-"}


def cheapest(kinds: str, start: int = NOTHING, goals: tuple[int, ...] = (NOTHING, ASSISTANT)) -> tuple[int, str] | None:
    """Cost and ASCII-least audit of the cheapest edits of a row sequence from ``start`` to one of ``goals``
    (None: there is no way).

    Both heaps go by cost and, among equal costs, by rows read (free edits read a row), so that a
    node's label, its cost and least audit, is final when it leaves its heap."""
    n = len(kinds)
    label = ({start: (0, "")}, {4 * n + g: (0, "") for g in goals})
    heaps = ([start], [g for g in goals])
    done: tuple[set, set] = (set(), set())
    best: tuple[int, str] | None = None
    while heaps[0] and heaps[1]:
        if best is not None and heaps[0][0] // _COST + heaps[1][0] // _COST > best[0]:
            break
        side = 0 if heaps[0][0] // _COST <= heaps[1][0] // _COST else 1
        at = heappop(heaps[side]) % _COST
        node = at if side == 0 else 4 * (n - at // 4) + at % 4
        if node in done[side]:
            continue
        done[side].add(node)
        cost, audit = label[side][node]
        row, state = divmod(node, 4)
        if node in done[1 - side]:
            other_cost, other = label[1 - side][node]
            found = (cost + other_cost, audit + other if side == 0 else other + audit)
            best = found if best is None or found < best else best
        if side == 0:
            steps = [(4 * row + NEXT[state], INSERT, "I")]
            if row < n:
                steps += [(4 * (row + 1) + to, c, x) for to, c, x in _FORWARD[kinds[row]][state]]
        else:
            steps = [(4 * row + b, INSERT, "I") for b in BEFORE[state]]
            if row:
                steps += [(4 * (row - 1) + to, c, x) for to, c, x in _BACKWARD[kinds[row - 1]][state]]
        for to, c, letter in steps:
            c += cost
            text = audit + letter if side == 0 else letter + audit
            if to in done[1 - side]:
                other_cost, other = label[1 - side][to]
                found = (c + other_cost, text + other if side == 0 else other + text)
                best = found if best is None or found < best else best
            if to in done[side]:
                continue
            old = label[side].get(to)
            if old is None or (c, text) < old:
                label[side][to] = (c, text)
                if old is None or c < old[0]:
                    heappush(heaps[side], c * _COST + (to if side == 0 else 4 * (n - to // 4) + to % 4))
    return best


_whole = lru_cache(maxsize=20_000)(cheapest)


def chunk_table(kinds: str) -> list[tuple[int, int, int, str]]:
    """(start, end, cost, audit) of a chunk's cheapest edits between every two states."""
    found = ((a, b, cheapest(kinds, a, (b,))) for a in range(4) for b in range(4))
    return [(a, b, *way) for a, b, way in found if way is not None]


def chain(tables: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[tuple[int, str]]]:
    """Cost of the cheapest way through the chunks, and per chunk the state it starts in and its audit."""
    ways = {NOTHING: (0, "", ())}
    for table in tables:
        new: dict[int, tuple] = {}
        for a, b, cost, audit in table:
            if a in ways:
                c, text, path = ways[a]
                way = (c + cost, text + audit, (path, a, audit))
                if b not in new or way[:2] < new[b][:2]:
                    new[b] = way
        ways = new
    cost, _, path = min((ways[s] for s in (NOTHING, ASSISTANT) if s in ways), key=lambda w: w[:2])
    out = []
    while path:
        path, a, audit = path
        out.append((a, audit))
    return cost, out[::-1]


def apply_edits(state: int, audit: str, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Repaired (role, text) turns of ``rows`` under an audit."""
    out, at = [], 0
    for edit in audit:
        if edit in "IR":
            state = NEXT[state]
            out.append(("user" if state == USER else "assistant", "" if edit == "I" else rows[at][1]))
        elif edit == "K":
            state = _KEPT[rows[at][0][:1]][0]
            out.append(rows[at])
        at += edit != "I"
    return out


def _joined(turns: list[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in turns)


def damage(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows with the contract's damage by crc32(`conv:turn`) % 20: 0 drops (``gone``), 1 empties, 2 loses ``.!?``, 3 repeats, 4 becomes user."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), said(role_col).alias("role"), said(text_col).alias("text"),
                       (F.crc32(F.concat(said(id_col), F.lit(":"), said(turn_col)).cast("binary")) % 20).alias("fate"))
    fate = F.col("fate")
    text = F.when(fate.isin(0, 1), "").when(fate == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv", "turn", F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (fate == 0).alias("gone"), F.explode(F.array_repeat(F.lit(0), F.when(fate == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def plain(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows as they are, in the columns that ``repair`` takes."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), said(role_col).alias("role"), said(text_col).alias("text"),
                       F.lit(False).alias("gone"))


def _visible() -> Column:
    return F.col("text").rlike(r"[^\x20\x09-\x0D]")


def _with_repeats(rows: DataFrame) -> DataFrame:
    """``seen``: whether the conversation holds the row's role and text at an earlier turn. Texts that were seen are not needed further."""
    rows = rows.withColumn("print", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))
    firsts = (rows.where(~F.col("gone") & _visible()).groupBy("conv", "print")
              .agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
              .select(F.col("conv").alias("_conv"), F.col("print").alias("_print"), "first"))
    joined = rows.join(firsts, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("print") == F.col("_print")), "left")
    seen = F.coalesce(F.struct("turn") > F.col("first"), F.lit(False))
    return joined.select("conv", "turn", "role", F.when(seen, "").otherwise(F.col("text")).cast("binary").alias("raw"), "gone", seen.alias("seen"),
                         F.when(F.col("first").isNotNull(), F.col("print")).alias("print"), F.xxhash64("role", "text").alias("tie"))


class _Rows:
    """Rows of one conversation, or of a chunk of it, with what the faults of a row need."""

    def __init__(self, conv):
        self.conv, self.size = conv, 0
        self.rows, self.kinds, self.turns = [], [], []
        self.blank = self.duplicate = self.truncated = 0

    def add(self, turn, role: str, raw: bytes, repeated: bool) -> None:
        body, first = raw.rstrip(_SPACE), role[:1]
        known = first if first in ("s", "u", "a") else "x"
        if repeated:
            self.duplicate += 1
            kind = "-"
        elif not body:
            self.blank += 1
            kind = "-"
        elif body[-1:] not in (b".", b"!", b"?"):
            self.truncated += 1
            kind = known.upper()
        else:
            kind = known
        self.kinds.append(kind)
        self.rows.append((role, "" if kind == "-" else raw.decode("utf-8", "replace")))
        self.turns.append(turn)
        self.size += len(raw)

    def illegal(self) -> int:
        first = [role[:1] for role, _ in self.rows]
        return sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))

    def spread(self) -> tuple[int | None, int | None, int]:
        """First and last turn, and how many different ones."""
        turns = [t for t in self.turns if t is not None]
        return (turns[0], turns[-1], len(set(turns))) if turns else (None, None, 0)


_SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_TURNS = "array<struct<role: string, text: string>>"


def _slices(batches: Iterator[pa.RecordBatch], with_turns: bool) -> Iterator[dict]:
    """Records of one sorted partition: whole conversations, and chunks of those that are long or touch its borders."""
    part = TaskContext.get().partitionId()
    held, number, chunk, before, began = None, 0, 0, None, False

    def record(whole: bool) -> dict:
        low, high, different = held.spread()
        out = {"conv": held.conv, "whole": whole, "part": part, "chunk": chunk, "blank": held.blank, "duplicate": held.duplicate,
               "truncated": held.truncated, "illegal": held.illegal()}
        kinds = "".join(held.kinds)
        if whole:
            out["cost"], out["audit"] = _whole(kinds)
            turns = apply_edits(NOTHING, out["audit"], held.rows)
            out["gaps"] = high - low + 1 - different if different else 0
            out["repaired_sha256"] = hashlib.sha256(_joined(turns).encode()).hexdigest()
            out["turns"] = [{"role": r, "text": t} for r, t in turns] if with_turns else None
            return out
        ends = held.rows and (held.rows[0][0][:1], held.rows[-1][0][:1]) or (None, None)
        return out | {"low": low, "high": high, "different": different, "first": ends[0], "last": ends[1],
                      "ways": [{"start": a, "stop": b, "price": c, "edits": x} for a, b, c, x in chunk_table(kinds)],
                      "turns": [{"role": r, "text": t} for r, t in held.rows]}

    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(7)]
        for conv, turn, role, raw, gone, seen, print_ in zip(*cols):
            if not began or conv != held.conv:
                if began:
                    yield record(whole=number > 0 and chunk == 0)
                    number += 1
                held, chunk, before, began = _Rows(conv), 0, None, True
            if gone:
                continue
            if len(held.rows) >= CHUNK_ROWS or held.size >= CHUNK_TEXT:
                yield record(whole=False)
                held, chunk = _Rows(conv), chunk + 1
            mark = (turn, print_)
            held.add(turn, role, raw, seen or (print_ is not None and mark == before))
            before = mark
    if began:
        yield record(whole=False)


def _chain_up(pieces: pd.DataFrame) -> pd.DataFrame:
    """One long conversation from its chunks' tables."""
    pieces = pieces.sort_values(["part", "chunk"])
    cost, path = chain([[(w["start"], w["stop"], w["price"], w["edits"]) for w in ways] for ways in pieces["ways"]])
    illegal, last, spread, edge = int(pieces["illegal"].sum()), None, 0, None
    low = high = None
    for p in pieces.itertuples():
        if p.first is not None:
            illegal += last is not None and last + p.first not in ("su", "ua", "au")
            last = p.last
        if p.different:
            p_low, p_high = int(p.low), int(p.high)
            spread += p.different - (p_low == edge)
            low, high, edge = p_low if low is None else low, p_high, p_high
    return pd.DataFrame({
        "conv": pieces["conv"].iloc[:1].tolist(), "gaps": [high - low + 1 - spread if spread else 0],
        **{c: [int(pieces[c].sum())] for c in ("blank", "duplicate", "truncated")}, "illegal": [illegal], "cost": [cost],
        "audit": ["".join(a for _, a in path)],
        "path": [[{"part": int(p), "chunk": int(c), "start": s, "edits": a}
                  for p, c, (s, a) in zip(pieces["part"], pieces["chunk"], path)]]})


def _digests(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each conversation's sorted chunks; one chunk's text is held at a time."""
    conv, state, empty = None, None, True
    for batch in batches:
        for i in range(batch.num_rows):
            one = {n: batch.column(n)[i].as_py() for n in ("conv", "start", "edits", "turns")}
            if state is None or one["conv"] != conv:
                if state is not None:
                    yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": state.hexdigest()}], schema)
                conv, state, empty = one["conv"], hashlib.sha256(), True
            turns = apply_edits(one["start"], one["edits"], [(t["role"], t["text"]) for t in one["turns"]])
            if turns:
                state.update((("" if empty else "\n") + _joined(turns)).encode())
                empty = False
    if state is not None:
        yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": state.hexdigest()}], schema)


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


class Repair:
    """``summary``: one row per conversation (faults, cost, audit, digest); ``turns()``: the repaired turns."""

    def __init__(self, rows: DataFrame, with_turns: bool = False):
        """``rows``: conv, turn, role, text, gone, as ``damage`` and ``plain`` give them."""
        spark, kind = rows.sparkSession, rows.schema["conv"].dataType.simpleString()
        ship_code(spark)
        schema = (f"conv {kind}, whole boolean, part int, chunk int, {_SUMMARY}, repaired_sha256 string, low long, high long, different long, "
                  f"first string, last string, ways array<struct<start: int, stop: int, price: long, edits: string>>, turns {_TURNS}")
        arrow = _arrow(spark, schema)

        def run(batches):
            held = []
            for one in _slices(batches, with_turns):
                held.append(one)
                if len(held) >= 500 or not one["whole"]:
                    yield pa.RecordBatch.from_pylist(held, arrow)
                    held = []
            if held:
                yield pa.RecordBatch.from_pylist(held, arrow)

        placed = (_with_repeats(rows).repartitionByRange("conv", "turn", "tie").sortWithinPartitions("conv", "turn", "tie", "role", "print")
                  .select("conv", F.col("turn").cast("long").alias("turn"), "role", "raw", "gone", "seen", "print"))
        self.slices = shared_table(spark, map_arrow(placed, run, schema), "conversation-slices")
        pieces = self.slices.where("NOT whole")
        # turns travel as text: pandas would turn a column of numbers and nulls into floats
        tables = pieces.select("conv", "part", "chunk", "blank", "duplicate", "truncated", "illegal", F.col("low").cast("string").alias("low"),
                               F.col("high").cast("string").alias("high"), "different", "first", "last", "ways")
        self.long = shared_table(spark, tables.groupBy("conv").applyInPandas(
            _chain_up, f"conv {kind}, {_SUMMARY}, path array<struct<part: int, chunk: int, start: int, edits: string>>"), "conversation-chains")
        step = self.long.select("conv", F.explode("path").alias("p")).select(
            F.col("conv").alias("_conv"), F.col("p.part").alias("_part"), F.col("p.chunk").alias("_chunk"), "p.start", "p.edits")
        same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")) & (F.col("chunk") == F.col("_chunk"))
        self.chosen = pieces.select("conv", "part", "chunk", "turns").join(step, same).drop("_conv", "_part", "_chunk")
        out = f"conv {kind}, repaired_sha256 string"
        digest_schema = _arrow(spark, out)
        digests = map_arrow(self.chosen.repartition("conv").sortWithinPartitions("conv", "part", "chunk").select("conv", "start", "edits", "turns"),
                            lambda batches: _digests(batches, digest_schema), out)
        columns = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        digests = digests.withColumnRenamed("conv", "_conv")
        long = self.long.join(digests, F.col("conv").eqNullSafe(F.col("_conv")))
        self.summary = self.slices.where("whole").select(*columns).unionByName(long.select(*columns))
        self.kind, self.with_turns = kind, with_turns

    def turns(self) -> DataFrame:
        """conv, part, chunk, place (order inside them), role, text of every repaired turn."""
        if not self.with_turns:
            raise ValueError("ask for turns when the repair is made")
        schema = f"conv {self.kind}, part int, chunk int, turns {_TURNS}"
        arrow = _arrow(self.slices.sparkSession, schema)

        def run(batches):
            for batch in batches:
                for one in batch.to_pylist():
                    turns = apply_edits(one["start"], one["edits"], [(t["role"], t["text"]) for t in one["turns"]])
                    yield pa.RecordBatch.from_pylist([{**{k: one[k] for k in ("conv", "part", "chunk")},
                                                       "turns": [{"role": r, "text": t} for r, t in turns]}], arrow)

        long = map_arrow(self.chosen, run, schema)
        every = self.slices.where("whole").select("conv", "part", "chunk", "turns").unionByName(long)
        return every.select("conv", "part", "chunk", F.posexplode("turns").alias("place", "turn")).select(
            "conv", "part", "chunk", "place", "turn.role", "turn.text")
