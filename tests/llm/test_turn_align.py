import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from millrace.llm import turn_align
from millrace.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, audit string"
SOME = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(turns):
    """[(initial, cost of staying or None)] to least (cost, audit), letter by letter over the automaton of the grammar."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for s, (c, a) in list(best.items()):
                t, new = after[s], (c + 5, a + "I")
                if t not in best or new < best[t]:
                    best[t] = new
        return best

    best = {"": (0, "")}
    for initial, stay in turns:
        new = {}

        def offer(s, way):
            if s not in new or way < new[s]:
                new[s] = way

        for s, (c, a) in inserted(best).items():
            offer(s, (c + 2, a + "D"))
            if stay is not None:
                if initial == after[s]:
                    offer(after[s], (c + stay, a + "K"))
                else:
                    offer(after[s], (c + stay + 1, a + "R"))
                if s == "" and initial == "s":
                    offer("s", (c + stay, a + "K"))
        best = new
    return min(v for s, v in inserted(best).items() if s in ("", "a"))


def broken(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if h:
            out += [(c, t, "user" if h == 4 else r, "" if h == 1 else re.sub("[.!?]", "", x) if h == 2 else x)] * (1 + (h == 3))
    return out


def report(rows, original):
    """What the query is to return, one conversation after another."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append(((t is not None, t or 0), r or "", x or ""))
    want = []
    for c in {c for c, *_ in original}:
        turns, seen, counts, edits = sorted(by[c]), set(), dict.fromkeys(("blank", "duplicate", "truncated"), 0), []
        for _, r, x in turns:
            words = SOME.findall(x)
            fault = "blank" if not words else "duplicate" if (r, x) in seen else "truncated" if words[-1] not in ".!?" else None
            seen.add((r, x))
            if fault:
                counts[fault] += 1
            edits.append((r[:1], None if fault in ("blank", "duplicate") else 5 * (fault == "truncated")))
        cost, audit = cheapest(edits)
        lines, left, state = [], iter(turns), ""
        for e in audit:
            if e == "D":
                next(left)
                continue
            turn = None if e == "I" else next(left)
            state = "s" if e == "K" and turn[1][:1] == "s" else "a" if state == "u" else "u"
            lines.append(f"{turn[1] if e == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{'' if e == 'I' else turn[2]}")
        at = [t[1] for t, *_ in turns if t[0]]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        want.append((c, max(at) - min(at) + 1 - len(set(at)) if at else 0, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(want, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query(spark, size):
    folder = f"/root/testdata/{size}"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_turn_structure"](spark, folder)
    assert got.columns == COLUMNS
    assert rows_of(got) == report(broken(rows), rows)


def test_alignment_is_the_cheapest_and_least():
    kinds = [("s", 0), ("u", 0), ("a", 0), ("x", 0), ("u", 5), ("a", None)]
    random.seed(2)
    cases = [list(c) for n in range(1, 5) for c in itertools.product(kinds, repeat=n)]
    cases += [[random.choice(kinds) for _ in range(random.randint(5, 40))] for _ in range(300)]
    for case in cases:
        turns = [(i, turn_align.NEVER if s is None else s, 2) for i, s in case]
        cost, audit, last = turn_align.align(turns, turn_align.START, turn_align.END)
        assert (cost, audit + "I" * len(turn_align.CLOSING[last])) == cheapest(case)


def test_pieces_multiply_to_the_whole():
    random.seed(4)
    for _ in range(60):
        turns = [random.choice([("s", 0, 2), ("u", 0, 2), ("a", 0, 2), ("u", 5, 2), ("x", turn_align.NEVER, 2)]) for _ in range(30)]
        whole = turn_align.matrix(turns[:7])
        for a in range(7, 30, 7):
            whole = turn_align._product(whole, turn_align.matrix(turns[a : a + 7]))
        assert whole == turn_align.matrix(turns)


def awkward():
    random.seed(5)
    roles = ["user", "assistant", "system", "tool", None, "", "User", "u", "human"]
    texts = ["a.", "b", "", " \n", None, "c? ", "same.", "d!\t", "e\x1c", "É."]

    def some(c, n):
        return [(c, t, random.choice(roles), random.choice(texts) if random.random() < 0.3 else f"t{t} of {c}.") for t in range(n)]

    rows = some(1, 900) + some(None, 300) + some(2, 129) + some(3, 1) + some(4, 128)
    rows += [(5, 1, "user", "same.")] * 700 + [(6, None, "user", "x."), (6, None, "assistant", "y."), (6, 3, "user", "z" * 200_000 + ".")]
    rows += [(7, None, None, None)] * 3 + [(8, t, "assistant" if t % 2 else "user", f"fine {t}.") for t in range(400)]
    rows += [(9, t, random.choice(["user", "assistant"]), f"w {t}.") for t in range(500)]
    rows += [(10, 5, "user", ""), (11, 2**40, "user", "far."), (11, 0, "system", "near.")]
    return rows


def test_long_and_awkward_conversations(spark, monkeypatch):
    rows = awkward()
    for piece in (5, 64):
        monkeypatch.setattr(turn_align, "PIECE", piece)
        df = spark.createDataFrame([(*r, "other") for r in rows], SCHEMA).repartition(7)
        repairs = turn_align.repair_turns(df)
        got = turn_align.audits(repairs)
        columns = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        assert got.columns == columns
        assert rows_of(got) == sorted(((w[0], *w[2:]) for w in report(rows, rows)), key=str)
    assert rows_of(turn_align.turn_gaps(df)) == sorted((w[:2] for w in report(rows, rows)), key=str)


def test_damaged_and_reported(spark):
    rows = awkward()
    df = spark.createDataFrame([(*r, "other") for r in rows], SCHEMA).repartition(5)
    assert rows_of(turn_align.structure_report(df)) == report(broken(rows), rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert turn_align.repair_turns(empty).collect() == []
    assert turn_align.structure_report(empty).collect() == []
