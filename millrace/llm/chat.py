"""Chat formatting with minimum-cost role repair.

A conversation is legal when an optional system message is followed by user and
assistant messages in turn, the last one from the assistant. A turn may be kept,
relabelled, or merged into the message before it, and empty messages may be
inserted; dynamic programming over the automaton of legal turns finds the
cheapest repair, and the repaired sequence is rendered.

A turn is a 4 x 4 matrix of costs between states, and a stretch of turns is the
(min, +) product of its turns. So a conversation of any length is handled in
pieces of at most ``PIECE`` turns: turns are dealt out by ranges of
(conversation, turn), pieces are scored on their own, the products of the pieces
give every piece its first and last state, and pieces are then repaired apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.shared import light_batches, only, written

PIECE = 1024
PIECE_CHARS = 4_000_000
MERGE, INSERT, RELABEL = 1.0, 2.0, 3.0
ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
INF = float("inf")
# after a state: the roles that may follow, and the empty messages that make another role legal
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
INSERTS = {(START, ASSISTANT): (USER,), (SYSTEM, ASSISTANT): (USER,), (USER, USER): (ASSISTANT,), (ASSISTANT, ASSISTANT): (USER,)}
CLOSING = {START: (USER, ASSISTANT), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def _steps(role: int | None) -> list[list[tuple[float, str, tuple]]]:
    """Cost, action and inserted roles of a turn of ``role``, by state before and state after."""
    table = [[(INF, "", ())] * 4 for _ in range(4)]
    for before in range(4):
        for after in (SYSTEM, USER, ASSISTANT):
            label = 0.0 if after == role else RELABEL
            verb = "keep" if after == role else "relabel"
            options = []
            if after in FOLLOWS[before]:
                options.append((label, verb, ()))
            if after == before:
                options.append((label + MERGE, "merge" if verb == "keep" else "relabel and merge", ()))
            if (before, after) in INSERTS:
                inserted = INSERTS[before, after]
                options.append((label + INSERT * len(inserted), verb, inserted))
            if options:
                table[before][after] = min(options, key=lambda o: o[0])  # the first of equal cost
    return table


STEPS = {role: _steps(role) for role in (None, SYSTEM, USER, ASSISTANT)}
COSTS = {role: np.array([[c for c, _, _ in row] for row in table]) for role, table in STEPS.items()}
END = np.array([INSERT * len(CLOSING[s]) for s in range(4)])
UNIT = np.where(np.eye(4, dtype=bool), 0.0, INF)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def role_of(name: str | None) -> int | None:
    name = (name or "").strip().lower()
    return ROLES.index(name) + 1 if name in ROLES else None


def stretch(roles: list[int | None]) -> np.ndarray:
    """Costs of a stretch of turns between each state before and after it."""
    total = UNIT
    for role in roles:
        total = product(total, COSTS[role])
    return total


def repair(roles: list[int | None], first: int, last: int | None) -> list[tuple[int, str, tuple]]:
    """State after, action and insertions of each turn on the cheapest way from ``first`` to ``last``, or to the end."""
    best, back = UNIT[first], []
    for role in roles:
        ways = best[:, None] + COSTS[role]
        back.append(ways.argmin(axis=0))
        best = ways.min(axis=0)
    state, out = int((best + END).argmin()) if last is None else last, []
    for role, origin in zip(reversed(roles), reversed(back)):
        before = int(origin[state])
        _, action, inserted = STEPS[role][before][state]
        out.append((state, action, inserted))
        state = before
    return out[::-1]


def _safe(text: str | None) -> str:
    return (text or "").replace("<|", "< |")


def render(turns: list[tuple[int, str, tuple]], texts: list[str | None], first: int, ends: bool) -> list[str]:
    """The text each turn adds; joined in order they are the whole conversation."""
    out, open_ = [], first != START
    for (state, action, inserted), text in zip(turns, texts):
        if "merge" in action:
            out.append("\n" + _safe(text))
            continue
        close = "<|end|>\n" if open_ else ""
        empty = "".join(f"<|{ROLES[r - 1]}|>\n<|end|>\n" for r in inserted)
        out.append(f"{close}{empty}<|{ROLES[state - 1]}|>\n{_safe(text)}")
        open_ = True
    if ends and out:
        out[-1] += "<|end|>\n" + "".join(f"<|{ROLES[r - 1]}|>\n<|end|>\n" for r in CLOSING[turns[-1][0]])
    return out


PIECES = "conv_id long, part int, piece int, turns array<long>, roles array<string>, texts array<string>, cost array<double>, part_cost array<double>"
PIECE_TYPES = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int32()), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())),
    ("texts", pa.list_(pa.string())), ("cost", pa.list_(pa.float64())), ("part_cost", pa.list_(pa.float64())),
])


def _pieces(turns: DataFrame) -> DataFrame:
    """Ordered turns to pieces, with the piece's cost matrix; the last piece of a
    conversation in a partition carries the matrix of all its pieces there."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, rows, size = TaskContext.get().partitionId(), [], [], 0
        conversation, number, whole = None, 0, UNIT

        def piece(last: bool) -> None:
            nonlocal rows, size, number, whole
            cost = stretch([role_of(r[2]) for r in rows])
            whole = product(whole, cost)
            _, t, r, x = zip(*rows)
            out.append({"conv_id": conversation[0], "part": part, "piece": number, "turns": t, "roles": r, "texts": x, "cost": cost.ravel().tolist(), "part_cost": whole.ravel().tolist() if last else None})
            rows, size, number = [], 0, number + 1
            if last:
                number, whole = 0, UNIT

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and (row[0],) != conversation:
                    piece(True)
                elif rows and (len(rows) >= PIECE or size >= PIECE_CHARS):
                    piece(False)
                conversation = (row[0],)
                rows.append(row)
                size += len(row[3] or "")
                if len(out) >= 500:
                    yield pa.RecordBatch.from_pylist(out, schema=PIECE_TYPES)
                    out = []
        if rows:
            piece(True)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=PIECE_TYPES)

    return turns.mapInArrow(cut, PIECES)


def _way(costs: list[np.ndarray], first: int, last: int | None) -> list[tuple[int, int]]:
    """States before and after each stretch on the cheapest way."""
    best, back = UNIT[first], []
    for cost in costs:
        ways = best[:, None] + cost
        back.append(ways.argmin(axis=0))
        best = ways.min(axis=0)
    state, out = int((best + END).argmin()) if last is None else last, []
    for origin in reversed(back):
        out.append((int(origin[state]), state))
        state = int(origin[state])
    return out[::-1]


def _part_states(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("part")
    way = _way([np.reshape(c, (4, 4)) for c in group["part_cost"]], START, None)
    return pd.DataFrame({"conv_id": group["conv_id"], "part": group["part"], "first": [a for a, _ in way], "last": [b for _, b in way], "ends": [False] * (len(way) - 1) + [True]})


def _piece_states(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("piece")
    way = _way([np.reshape(c, (4, 4)) for c in group["cost"]], int(group["first"].iloc[0]), int(group["last"].iloc[0]))
    ends = [False] * (len(way) - 1) + [bool(group["ends"].iloc[0])]
    return pd.DataFrame({"conv_id": group["conv_id"], "part": group["part"], "piece": group["piece"], "first": [a for a, _ in way], "last": [b for _, b in way], "ends": ends})


def format_chats(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per turn: conv_id, turn, role, new_role, action, inserted, rendered.

    Turns are ordered by turn, role and text, so ties have one order and repeated
    rows are merged or answered like any others. ``inserted`` counts the empty
    messages before the turn, or behind it where it is the last; ``rendered`` is
    what the turn adds to the text of the conversation. Null and unknown roles
    are relabelled; null texts are empty; null turns come first; rows without a
    conv_id are one conversation; an empty table gives none; other columns are
    ignored.
    """
    light_batches(conversations.sparkSession)
    turns = only(conversations, conv_id=conv_id, turn=turn, role=role, text=text)
    turns = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    # equal rows may be told apart for the deal, as any order of them gives the same result
    order = ["conv_id", "turn", "role", "text"]
    dealt = turns.withColumn("_n", F.monotonically_increasing_id()).repartitionByRange(*order, "_n").sortWithinPartitions(*order).drop("_n")
    pieces = written(_pieces(dealt), "pieces")

    # conversations in one piece need no more; the others get the states between their pieces
    parts = pieces.where("part_cost is not null").select("conv_id", "part", "part_cost", "piece")
    long = parts.groupBy("conv_id").agg((F.count("*") + F.max("piece")).alias("n")).where("n > 1").select(F.col("conv_id").alias("c"))
    is_long = F.col("conv_id").eqNullSafe(F.col("c"))
    part_states = parts.join(long, is_long, "left_semi").drop("piece").groupBy("conv_id").applyInPandas(_part_states, "conv_id long, part int, first int, last int, ends boolean")
    p = part_states.select(F.col("conv_id").alias("c"), F.col("part").alias("q"), "first", "last", "ends")
    states = pieces.select("conv_id", "part", "piece", "cost").join(p, is_long & (F.col("part") == F.col("q"))).drop("c", "q")
    states = states.groupBy("conv_id", "part").applyInPandas(_piece_states, "conv_id long, part int, piece int, first int, last int, ends boolean")
    s = written(states.select(F.col("conv_id").alias("c"), F.col("part").alias("q"), F.col("piece").alias("k"), "first", "last", "ends"), "states")
    known = pieces.drop("cost", "part_cost").join(s, is_long & (F.col("part") == F.col("q")) & (F.col("piece") == F.col("k")), "left")
    known = known.select("conv_id", "turns", "roles", "texts", F.coalesce("first", F.lit(START)).alias("first"), F.coalesce("last", F.lit(-1)).alias("last"), F.coalesce("ends", F.lit(True)).alias("ends"))

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "turn", "role", "new_role", "action", "inserted", "rendered"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string()]
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = []
                for x in batch.slice(at, 200).to_pylist():
                    done = repair([role_of(r) for r in x["roles"]], x["first"], None if x["last"] < 0 else x["last"])
                    texts = render(done, x["texts"], x["first"], x["ends"])
                    for n, ((state, action, inserted), text) in enumerate(zip(done, texts)):
                        behind = len(CLOSING[state]) if x["ends"] and n == len(done) - 1 else 0
                        rows.append((x["conv_id"], x["turns"][n], x["roles"][n], ROLES[state - 1], action, len(inserted) + behind, text))
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return known.mapInArrow(repaired, "conv_id long, turn long, role string, new_role string, action string, inserted int, rendered string")
