import itertools
import random
import re
from collections import defaultdict

from millrace.llm import chat
from millrace.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, action string"


def legal(states):
    at = chat.START
    for s in states:
        if s not in chat.FOLLOWS[at]:
            return False
        at = s
    return at == chat.ASSISTANT


def cheapest(roles):
    """Least cost over all labels, merges and up to two insertions before each turn."""
    inserts = [i for k in range(3) for i in itertools.product((1, 2, 3), repeat=k)]

    def ways(state, then):
        for ins in inserts:
            at = state
            for s in (*ins, *then):
                if s not in chat.FOLLOWS[at]:
                    break
                at = s
            else:
                yield len(ins) * chat.INSERT, at

    costs = {chat.START: 0.0}
    for role in roles:
        new = {}
        for state, c in costs.items():
            for label in (1, 2, 3):
                own = c + (0 if label == role else chat.RELABEL)
                options = [own + more for more, _ in ways(state, (label,))] + ([own + chat.MERGE] if state == label else [])
                if options:
                    new[label] = min(new.get(label, 1e9), *options)
        costs = new
    return min(c + more for s, c in costs.items() for more, at in ways(s, ()) if at == chat.ASSISTANT)


def cost(rows):
    return sum((chat.RELABEL if r.new_role != (r.role or "").strip().lower() else 0) + (chat.MERGE if "merge" in r.action else 0) + chat.INSERT * r.inserted for r in rows)


def check(rows, turns):
    by, want = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.conv_id].append(r)
    for c, t, r, x in turns:
        want[c].append((t, r, x))
    assert by.keys() == want.keys()
    for c, own in by.items():
        given = sorted(want[c], key=lambda v: tuple((x is not None, x) for x in v))
        assert sorted(str((r.turn, r.role)) for r in own) == sorted(str((t, r)) for t, r, _ in given)
        assert cost(own) == sum_cost([r for _, r, _ in given])
        if all(t is not None for t, *_ in given) and len({t for t, *_ in given}) == len(given):
            text = "".join(r.rendered for r in sorted(own, key=lambda r: r.turn))
            assert legal([chat.ROLES.index(h) + 1 for h in re.findall(r"<\|(system|user|assistant)\|>\n", text)])
            assert text.count("<|end|>") == len(re.findall(r"<\|(?:system|user|assistant)\|>", text))


def sum_cost(roles):
    done = chat.repair([chat.role_of(r) for r in roles], chat.START, None)
    return sum((chat.RELABEL if s != chat.role_of(r) else 0) + (chat.MERGE if "merge" in a else 0) + chat.INSERT * len(i) for (s, a, i), r in zip(done, roles)) + chat.INSERT * len(chat.CLOSING[done[-1][0]])


def test_repair_is_cheapest():
    names = {None: None, 1: "system", 2: "user", 3: "assistant"}
    for n in range(1, 5):
        for roles in itertools.product(names, repeat=n):
            assert sum_cost([names[r] for r in roles]) == cheapest(roles)


def test_query(spark, folder):
    turns = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    check(QUERIES["op9_chat_repair"](spark, folder).collect(), turns)


def test_long_and_awkward_conversations(spark, monkeypatch):
    random.seed(3)
    roles = ["user", "assistant", "system", "tool", None, "USER", " assistant"]
    turns = [(c, t, random.choice(roles), f"t{c}.{t}") for c, n in ((1, 3000), (2, 3), (3, 1), (None, 1500), (5, 700)) for t in range(n)]
    turns += [(7, 1, "user", "same")] * 400 + [(8, None, "user", None), (8, 0, "user", "<|user|>"), (8, 0, "assistant", "")] + [(9, 0, "user", "x" * 300_000)]
    monkeypatch.setattr(chat, "PIECE", 50)
    rows = chat.format_chats(spark.createDataFrame([(*t, "x") for t in turns], SCHEMA).repartition(7)).collect()
    check(rows, turns)
    assert len(rows) == len(turns)


def test_empty_table(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).collect() == []
