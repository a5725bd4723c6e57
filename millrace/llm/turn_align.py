"""Conversation structure repair by aligning turns with the strings of a grammar.

A conversation is well formed when the initials of its roles read
``(s?(ua)+)?``: an optional system turn, then user and assistant in turn. Turns
may be kept, given another role or deleted and empty turns inserted; blank and
repeated turns must go.

Strings of the grammar that end alike have the same tails, so one Wagner-Fischer
table (turns left against letters left) holds the cost of every feasible length
at once. A cheap repair found beforehand, the incumbent, bounds the diagonals
that can hold the best alignment (Ukkonen's band). Lengths of least cost are
traced back and their audits compared.

A conversation is cut into pieces of at most ``PIECE`` turns. For a piece the
least cost between each state before and after it is a 4 x 4 matrix; products of
matrices tell each piece what every state behind it still costs, and with that
each piece is aligned apart. Pieces are carried over in two levels, partitions
and pieces within them, so no task holds a conversation of any length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.shared import light_batches, only, written

PIECE = 128
PIECE_CHARS = 4_000_000
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEVER = 10**9
# what the turns so far end with
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
LETTER = {USER: "u", ASSISTANT: "a"}
ROLE = {"u": "user", "a": "assistant"}
# behind the last turn: what completes the string, and its cost
CLOSING = {START: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}
END = [INSERT * len(CLOSING[s]) for s in range(4)]
WORD = re.compile(r"[^\x20\x09-\x0D]")
BLANK, DUPLICATE, CUT_OFF = "blank", "duplicate", "truncated"

Turn = tuple[str, int, int]  # initial, cost of staying, cost of going


def faults(texts: list[str | None], repeated: list[bool]) -> list[str | None]:
    """The first fault of each turn."""
    out = []
    for text, again in zip(texts, repeated):
        text = (text or "").rstrip(" \t\n\x0b\x0c\r")
        out.append(BLANK if not WORD.search(text) else DUPLICATE if again else CUT_OFF if text[-1] not in ".!?" else None)
    return out


def turn_costs(roles: list[str | None], found: list[str | None]) -> list[Turn]:
    return [((r or "")[:1], NEVER if f in (BLANK, DUPLICATE) else TRUNCATED * (f == CUT_OFF), DELETE) for r, f in zip(roles, found)]


def match(turn: Turn, letter: str) -> int:
    """Cost of a turn standing for a letter of the grammar."""
    initial, stay, _ = turn
    return min(NEVER, stay + (0 if initial == letter else REROLE if letter != "s" else NEVER))


def incumbent(turns: list[Turn]) -> int:
    """Cost of an easy repair from any state into any: what may stay stays in turn, the ends are filled up."""
    cost, state = 3 * INSERT, ASSISTANT
    for turn in turns:
        letter = LETTER[NEXT[state]]
        if match(turn, letter) < DELETE:
            cost, state = cost + match(turn, letter), NEXT[state]
        else:
            cost += DELETE
    return cost


class Table:
    """``rows[end][i][r]``: least cost of turns i.. as the ``r`` letters of u and a in turn that close with ``end``.

    Nothing is inserted behind the last turn here. Entries of more than
    ``limit`` may be too high; no others are wrong.
    """

    def __init__(self, turns: list[Turn], limit: int):
        n = len(turns)
        self.turns, self.limit, self.width = turns, limit, n + limit // INSERT + 1
        self.rows = {}
        for end, other in (("a", "u"), ("u", "a")):
            row = np.full(self.width, NEVER, np.int64)
            row[0] = 0
            rows = [row]
            for i in range(n - 1, -1, -1):
                below, left = rows[-1], n - i
                # the band: a diagonal this far off costs more than the limit by insertions or deletions alone
                lo, hi = max(0, left - limit // DELETE), min(self.width, left + limit // INSERT + 1)
                row = np.full(self.width, NEVER, np.int64)
                band = below[lo:hi] + DELETE
                if hi > 1:
                    at = max(lo, 1)
                    letters = np.where(np.arange(at, hi) % 2 == 1, match(turns[i], end), match(turns[i], other))
                    band[at - lo :] = np.minimum(band[at - lo :], below[at - 1 : hi - 1] + letters)
                steps = INSERT * np.arange(hi - lo)
                row[lo:hi] = np.minimum(np.minimum.accumulate(band - steps) + steps, NEVER)
                rows.append(row)
            self.rows[end] = rows[::-1]

    def lengths(self, first: str, end: str) -> np.ndarray:
        """The feasible lengths of strings from ``first`` to ``end``; none is empty."""
        return np.arange(1 if first == end else 2, self.width, 2)

    def least(self, first: str, end: str, i: int = 0) -> int:
        lengths = self.lengths(first, end)
        return int(self.rows[end][i][lengths].min()) if len(lengths) else NEVER

    def audit(self, end: str, r: int, i: int = 0) -> str:
        """The ASCII-least of the cheapest alignments with ``r`` letters: D before I before K before R."""
        rows, turns, other = self.rows[end], self.turns, "u" if end == "a" else "a"
        out = []
        while i < len(turns):
            now, letter = rows[i][r], end if r % 2 else other
            if now == DELETE + rows[i + 1][r]:
                out.append("D")
                i += 1
            elif r and now == INSERT + rows[i][r - 1]:
                out.append("I")
                r -= 1
            else:
                out.append("K" if turns[i][0] == letter else "R")
                i, r = i + 1, r - 1
        return "".join(out)


def _kept_system(turns: list[Turn]) -> list[tuple[int, int]]:
    """Turns that may open the string as its system turn, and the cost up to and with them."""
    return [(i, DELETE * i + t[1]) for i, t in enumerate(turns) if t[0] == "s" and t[1] < NEVER]


def _ways(table: Table, first: int, last: int) -> int:
    """Least cost of all turns from state ``first`` to ``last``, without insertions behind them."""
    n = len(table.turns)
    least = DELETE * n if first == last else NEVER
    if last in LETTER:
        least = min(least, table.least(LETTER[NEXT[first]], LETTER[last]))
    if first == START and last != START:
        for i, cost in _kept_system(table.turns):
            least = min(least, cost + (DELETE * (n - i - 1) if last == SYSTEM else table.least("u", LETTER[last], i + 1)))
    return least


def matrix(turns: list[Turn]) -> list[int]:
    """Least costs from each state (row) to each (column) over a piece."""
    limit = incumbent(turns)
    while True:
        table = Table(turns, limit)
        costs = [[_ways(table, a, b) for b in range(4)] for a in range(4)]
        if max(costs[a][b] for a in range(4) for b in (USER, ASSISTANT)) <= limit:
            return [c for row in costs for c in row]
        limit *= 2  # a way into some state was outside of the band


def align(turns: list[Turn], first: int, after: list[int]) -> tuple[int, str, int]:
    """Cost, audit and last state of the best alignment from a state on.

    ``after`` holds what each last state still costs. Of all lengths of equal
    cost the ASCII-least audit wins.
    """
    n, limit = len(turns), incumbent(turns) + max(after)
    while True:
        table = Table(turns, limit)
        totals = [_ways(table, first, s) + after[s] for s in range(4)]
        best = min(totals)
        if best <= limit:
            break
        limit *= 2
    found = []
    for last in range(4):
        if totals[last] != best:
            continue
        own = best - after[last]
        if first == last and own == DELETE * n:
            found.append(("D" * n, last))
        if last in LETTER:
            found += [(table.audit(LETTER[last], int(r)), last) for r in table.lengths(LETTER[NEXT[first]], LETTER[last]) if table.rows[LETTER[last]][0][r] == own]
        for i, cost in _kept_system(turns) if first == START else []:
            if last == SYSTEM and cost + DELETE * (n - i - 1) == own:
                found.append(("D" * i + "K" + "D" * (n - i - 1), last))
            elif last in LETTER:
                rows = table.rows[LETTER[last]][i + 1]
                found += [("D" * i + "K" + table.audit(LETTER[last], int(r), i + 1), last) for r in table.lengths("u", LETTER[last]) if cost + rows[r] == own]
    audit, last = min(found)
    return best, audit, last


def repaired(audit: str, roles: list[str | None], texts: list[str | None], first: int) -> list[tuple[str, str]]:
    """Role and text of each turn that an audit leaves."""
    out, state, i = [], first, 0
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        own = edit == "K"
        state = SYSTEM if own and (roles[i] or "")[:1] == "s" else NEXT[state]
        out.append(((roles[i] or "") if own else ROLE[LETTER[state]], "" if edit == "I" else texts[i] or ""))
        i += edit != "I"
    return out


# pieces

ID = "conv_id long, part int, piece int"
PIECES = f"{ID}, turns array<long>, roles array<string>, texts array<string>, keys array<string>"
PIECE_TYPES = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int32()), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("keys", pa.list_(pa.string())),
])


def _key(role: str | None, text: str | None) -> str:
    return hashlib.sha256(f"{role or ''}\0{text or ''}".encode(errors="replace")).hexdigest()


def _pieces(turns: DataFrame) -> DataFrame:
    """Ordered turns to pieces of a conversation within a partition."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, rows, size = TaskContext.get().partitionId(), [], [], 0
        conversation, number, held = None, 0, 0

        def piece() -> None:
            nonlocal rows, size, number, held
            _, t, r, x = zip(*rows)
            out.append({"conv_id": conversation[0], "part": part, "piece": number, "turns": t, "roles": r, "texts": x, "keys": [_key(a, b) for a, b in zip(r, x)]})
            rows, number, held, size = [], number + 1, held + size, 0

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and (row[0],) != conversation:
                    piece()
                    number = 0
                elif rows and (len(rows) >= PIECE or size >= PIECE_CHARS):
                    piece()
                conversation = (row[0],)
                rows.append(row)
                size += len(row[3] or "")
                if len(out) >= 500 or held >= PIECE_CHARS:
                    yield pa.RecordBatch.from_pylist(out, schema=PIECE_TYPES)
                    out, held = [], 0
        if rows:
            piece()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=PIECE_TYPES)

    return turns.mapInArrow(cut, PIECES)


def _same(a: str, b: str, *names: str):
    """Rows of two tables that belong together; ids may be null."""
    on = F.lit(True)
    for n in names:
        on = on & F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}"))
    return on


def _carried(elements: DataFrame, compose: Callable, apply: Callable, unit: list, forward: bool) -> DataFrame:
    """Per piece ``state``: ``unit`` changed by all pieces before it, or behind it.

    ``elements``: conv_id, part, piece, element array<long>. ``compose`` joins the
    elements of neighbours, ``apply`` changes a state by an element.
    """

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for e in group.sort_values("piece")["element"]:
            whole = list(e) if whole is None else compose(whole, list(e))
        return pd.DataFrame({"conv_id": group["conv_id"].iloc[:1], "part": group["part"].iloc[:1], "element": [whole]})

    def walk(order: str) -> Callable:
        def states(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values(order, ascending=forward)
            state, out = list(group["state"].iloc[0]) if "state" in group else unit, []
            for e in group["element"]:
                out.append(state)
                state = apply(state, list(e))
            return group.drop(columns=["element", "state"], errors="ignore").assign(state=out)

        return states

    parts = elements.groupBy("conv_id", "part").applyInPandas(fold, "conv_id long, part int, element array<long>")
    parts = parts.groupBy("conv_id").applyInPandas(walk("part"), "conv_id long, part int, state array<long>")
    both = elements.alias("e").join(parts.alias("p"), _same("e", "p", "conv_id", "part")).select("e.*", "p.state")
    return both.groupBy("conv_id", "part").applyInPandas(walk("piece"), f"{ID}, state array<long>")


def _product(a: list, b: list) -> list:
    x, y = np.reshape(a, (4, 4)), np.reshape(b, (4, 4))
    return np.minimum((x[:, :, None] + y[None, :, :]).min(axis=1), NEVER).ravel().tolist()


def _behind(state: list, element: list) -> list:
    """Cost to the end from each state before a piece, given it from each state behind it."""
    return np.minimum((np.reshape(element, (4, 4)) + np.array(state)).min(axis=1), NEVER).tolist()


def _then(a: list, b: list) -> list:
    """Maps of states, with the initial and turn that the piece ends with."""
    return [b[s] for s in a[:4]] + b[4:]


def _enter(state: list, element: list) -> list:
    return [element[state[0]], *element[4:]]


def _on_pieces(pieces: DataFrame, make: Callable[[dict], dict], schema: str, types: pa.Schema) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                yield pa.RecordBatch.from_pylist([make(x) for x in batch.slice(at, 100).to_pylist()], schema=types)

    return pieces.mapInArrow(run, schema)


def _repeated(x: dict) -> list[bool]:
    """Which turns were seen before: in the piece, or by the positions found over the conversation."""
    if x.get("again") is not None:
        known = set(x["again"])
        return [i in known for i in range(len(x["keys"]))]
    seen, out = set(), []
    for k in x["keys"]:
        out.append(k in seen)
        seen.add(k)
    return out


def _turns(x: dict) -> tuple[list[Turn], list[str | None]]:
    found = faults(x["texts"], _repeated(x))
    return turn_costs(x["roles"], found), found


def _code(role: str | None) -> int:
    return ord(role[0]) if role else 0


LEGAL = {"su", "ua", "au"}


def _result(x: dict) -> dict:
    """One piece repaired, given its first state and what the states behind it cost."""
    state = x["entry"] or [START, -1, 0]
    turns, found = _turns(x)
    _, audit, last = align(turns, state[0], x["after"] or END)
    lines = repaired(audit, x["roles"], x["texts"], state[0])
    if x["ends"]:
        audit += "I" * len(CLOSING[last])
        lines += [(ROLE[c], "") for c in CLOSING[last]]
    initials = [chr(state[1]) if state[1] > 0 else ""] * (state[1] >= 0) + [(r or "")[:1] for r in x["roles"]]
    own = sum((REROLE if e == "R" else DELETE if e == "D" else INSERT if e == "I" else 0) for e in audit)
    kept = iter(t for t, e in zip(turns, audit.replace("I", "")) if e != "D")
    return {
        "conv_id": x["conv_id"], "part": x["part"], "piece": x["piece"], "whole": x["whole"], "audit": audit, "roles": [r for r, _ in lines], "texts": [t for _, t in lines],
        "blank": found.count(BLANK), "duplicate": found.count(DUPLICATE), "truncated": found.count(CUT_OFF),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), "cost": own + sum(t[1] for t in kept),
    }


RESULT = f"{ID}, whole boolean, audit string, roles array<string>, texts array<string>, blank long, duplicate long, truncated long, illegal long, cost long"
RESULT_TYPES = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int32()), ("whole", pa.bool_()), ("audit", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()),
])
ELEMENT_TYPES = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int32()), ("element", pa.list_(pa.int64()))])


def repair_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per piece: conv_id, part, piece, whole, audit, roles, texts, blank, duplicate, truncated, illegal, cost.

    ``part`` and ``piece`` order the pieces of a conversation and ``whole`` marks
    those that are one. ``audit`` has the initials of the edits in order (Keep,
    Rerole, Delete, Insert), ``roles`` and ``texts`` the turns that are left. The
    counts are first faults and adjacent roles that the grammar does not allow,
    those between a piece and the one before it in the later one. Of the cheapest
    repairs the one with the ASCII-least audit is made, over all pieces.

    Turns are ordered by turn (nulls first), role and text, so rows of one turn
    have one order and equal rows are repeats of the first. Null roles and texts
    are empty, and an empty text is a blank turn; rows without a conv_id are one
    conversation. A text of any length is held in memory once, a conversation of
    any number of turns never as a whole. An empty table gives no rows; other
    columns are ignored.
    """
    light_batches(conversations.sparkSession)
    turns = only(conversations, conv_id=conv_id, turn=turn, role=role, text=text)
    turns = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    order = ["conv_id", "turn", "role", "text"]
    # equal rows may be told apart for the deal, as any order of them gives the same result
    dealt = turns.withColumn("_n", F.monotonically_increasing_id()).repartitionByRange(*order, "_n").sortWithinPartitions(*order).drop("_n")
    pieces = written(_pieces(dealt), "turns")

    ids = pieces.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1")
    long = written(pieces.alias("a").join(ids.alias("b"), _same("a", "b", "conv_id"), "left_semi"), "long")

    # repeats over all pieces: the first place of each key that has several
    places = long.select("conv_id", "part", "piece", F.posexplode("keys").alias("place", "key"))
    here = F.struct("part", "piece", "place")
    firsts = places.groupBy("conv_id", "key").agg(F.min(here).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = places.alias("a").join(firsts.alias("b"), _same("a", "b", "conv_id", "key")).where("struct(a.part, a.piece, a.place) > b.first")
    again = later.select("a.*").groupBy("conv_id", "part", "piece").agg(F.collect_list("place").alias("again"))  # PIECE at most
    at = ("conv_id", "part", "piece")
    known = long.drop("turns").alias("a").join(again.alias("b"), _same("a", "b", *at), "left").select("a.*", F.coalesce("b.again", F.expr("array()")).alias("again"))

    costs = _on_pieces(known, lambda x: {k: x[k] for k in at} | {"element": matrix(_turns(x)[0])}, f"{ID}, element array<long>", ELEMENT_TYPES)
    after = written(_carried(written(costs, "costs"), _product, _behind, END, forward=False).withColumnRenamed("state", "after"), "after")
    known = known.alias("a").join(after.alias("b"), _same("a", "b", *at)).select("a.*", "b.after")

    def ways(x: dict) -> dict:
        turns, _ = _turns(x)
        return {k: x[k] for k in at} | {"element": [align(turns, s, x["after"])[2] for s in range(4)] + [_code(x["roles"][-1])]}

    steps = written(_on_pieces(known, ways, f"{ID}, element array<long>", ELEMENT_TYPES), "steps")
    entry = _carried(steps, _then, _enter, [START, -1], forward=True).withColumnRenamed("state", "entry")
    ends = steps.groupBy("conv_id").agg(F.max(F.struct("part", "piece")).alias("last"))
    entry = entry.alias("a").join(ends.alias("b"), _same("a", "b", "conv_id")).select("a.*", (F.struct("a.part", "a.piece") == F.col("b.last")).alias("ends"))
    long = known.alias("a").join(entry.alias("b"), _same("a", "b", *at)).select("a.conv_id", "a.part", "a.piece", "a.roles", "a.texts", "a.keys", "a.again", "a.after", "b.entry", "b.ends", F.lit(False).alias("whole"))
    none = F.lit(None)
    short = pieces.alias("a").join(ids.alias("b"), _same("a", "b", "conv_id"), "left_anti")
    short = short.select(*at, "roles", "texts", "keys", none.cast("array<int>").alias("again"), none.cast("array<long>").alias("after"), none.cast("array<long>").alias("entry"), F.lit(True).alias("ends"), F.lit(True).alias("whole"))
    return _on_pieces(short.unionByName(long), _result, RESULT, RESULT_TYPES)


def audits(repairs: DataFrame) -> DataFrame:
    """Per conversation: the counts, cost, audit and repaired_sha256 of ``repair_turns``.

    ``repaired_sha256`` is the SHA-256 of the lines ``role:text``, joined by line
    breaks. A digest runs through a text in order, so conversations of several
    pieces are read as ordered streams of pieces; one piece is in memory at a time.
    """
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    rows = repairs.select("conv_id", "part", "piece", "whole", *counts, "audit", lines.alias("lines"), F.size("roles").alias("n"))
    rows = written(rows, "repairs")
    whole = rows.where("whole").select("conv_id", *counts, "audit", F.sha2("lines", 256).alias("repaired_sha256"))

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", *counts, "audit", "repaired_sha256"]
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        now, sums, audit, digest, some = None, None, [], None, False

        def done():
            return pa.record_batch([pa.array([v], k) for v, k in zip([now[0], *sums, "".join(audit), digest.hexdigest()], kinds)], names=names)

        for batch in batches:
            for x in batch.to_pylist():
                if now != (x["conv_id"],):
                    if now is not None:
                        yield done()
                    now, sums, audit, digest, some = (x["conv_id"],), [0] * len(counts), [], hashlib.sha256(), False
                sums = [a + x[c] for a, c in zip(sums, counts)]
                audit.append(x["audit"])
                if x["n"]:
                    digest.update((("\n" if some else "") + x["lines"]).encode())
                    some = True
        if now is not None:
            yield done()

    ordered = rows.where("not whole").drop("whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    kinds = ", ".join(f"{c} long" for c in ["conv_id", *counts])
    return whole.union(ordered.mapInArrow(streamed, f"{kinds}, audit string, repaired_sha256 string"))


def turn_gaps(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Per conversation ``gaps``: how many turn numbers between the first and the last are missing.

    Null turns are passed over, 0 where all are null; rows without a conv_id are
    one conversation, repeated turns count once, an empty table gives no rows.
    """
    own = only(conversations, conv_id=conv_id, turn=turn).select("conv_id", F.col("turn").cast("long").alias("turn"))
    once = own.distinct().groupBy("conv_id").agg(F.max("turn").alias("hi"), F.min("turn").alias("lo"), F.count("turn").alias("n"))
    return once.select("conv_id", F.coalesce(F.expr("hi - lo + 1 - n"), F.lit(0)).cast("long").alias("gaps"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns damaged by the hash of ``conv_id:turn``: some dropped, emptied, cut short, repeated or given to the user.

    Nulls are one space in the hash and in roles and texts.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = only(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    rows = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(key) % 20).alias("_how"))
    text = F.when(F.col("_how") == 1, "").when(F.col("_how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_how") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("_how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where("_how <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def structure_report(conversations: DataFrame) -> DataFrame:
    """The damaged conversations repaired: a row for every conversation of the table."""
    broken = damaged(conversations)
    every = conversations.select("conv_id").distinct()
    done = audits(repair_turns(broken)).alias("r")
    gaps = turn_gaps(broken).alias("g")
    joined = every.alias("e").join(done, _same("e", "r", "conv_id"), "left").join(gaps, _same("e", "g", "conv_id"), "left")
    counts = ["g.gaps", *(f"r.{c}" for c in ("blank", "duplicate", "truncated", "illegal", "cost"))]
    return joined.select("e.conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c[2:]) for c in counts), F.coalesce("r.audit", F.lit("")).alias("audit"), F.coalesce("r.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
