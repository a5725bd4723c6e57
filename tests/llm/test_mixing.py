from collections import Counter, defaultdict

import pytest

from helpers import SPACED, awkward_docs, frame
from millrace.llm import mixing
from millrace.llm.queries import DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS, QUERIES


def fill(budget, children):
    """Shares of {name: (capacity, weight)} by repeated redistribution."""
    share, open_ = dict.fromkeys(children, 0.0), {c for c, (_, w) in children.items() if w > 0}
    while open_ and budget > 1e-9:
        weights = sum(children[c][1] for c in open_)
        full = [c for c in open_ if budget * children[c][1] / weights >= children[c][0]]
        for c in full or open_:
            share[c] = children[c][0] if full else budget * children[c][1] / weights
        if not full:
            break
        budget -= sum(share[c] for c in full)
        open_ -= set(full)
    return share


def budgets(tokens, weights, total, epochs, path=(), default=1.0):
    """Leaf budgets of {leaf path: tokens}, from the root down."""
    if len(path) == len(weights):
        return {path: total}
    below = defaultdict(float)
    for leaf, n in tokens.items():
        if leaf[: len(path)] == path:
            below[leaf[len(path)]] += n * epochs
    shares = fill(total, {c: (n, weights[len(path)].get(c, default)) for c, n in below.items()})
    return {leaf: b for c, s in shares.items() for leaf, b in budgets(tokens, weights, s, epochs, (*path, c), default).items()}


def check(rows, tokens_of_leaf, weights, total, epochs, levels):
    want = budgets(tokens_of_leaf, weights, total, epochs)
    got, spread, longest, orders = Counter(), defaultdict(set), Counter(), defaultdict(list)
    for r in rows:
        leaf = tuple(r[c] for c in levels)
        got[leaf] += r.copies * r.n_tokens
        spread[leaf].add(r.copies)
        longest[leaf] = max(longest[leaf], r.n_tokens)
        orders[leaf].append(r)
        assert r.copies <= epochs
    for leaf, budget in want.items():
        assert got[leaf] <= budget + 1e-3 and budget - got[leaf] <= longest[leaf] + 1  # a prefix: short by less than a document
        assert max(spread[leaf]) - min(spread[leaf]) <= 1  # whole epochs, and one in part


def test_query(spark, folder):
    from millrace.llm.queries import with_domain

    docs = with_domain(spark.read.parquet(f"{folder}/documents.parquet")).collect()
    rows = QUERIES["op6_mixture"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs)
    tokens = Counter()
    for r in docs:
        tokens[r.domain, r.lang, r.source] += len(SPACED.findall(r.text or ""))
    check(rows, tokens, [DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS, {}], sum(tokens.values()), 4, ["domain", "lang", "source"])


def table(spark):
    rows = [(d, "w " * (1 + d * 37 % 90), ["en", "de", None][d % 3], f"s{d % 7 if d % 2 else 0}", 1) for d in range(600)]
    return rows, frame(spark, rows)


@pytest.mark.parametrize("total,epochs", [(None, 1), (9_000, 1), (40_000, 3), (10**9, 2), (0, 1)])
def test_budgets_and_prefixes(spark, monkeypatch, total, epochs):
    rows, docs = table(spark)
    weights = [{"en": 0.5, "de": 3.0, None: 1.0}, {"s0": 0.1, "s3": 5.0, "s5": 0.0}]
    # a null node has no weight of its own and takes the default
    got = mixing.mixture(docs, ["lang", "source"], weights, total=total, max_epochs=epochs, seed=1).collect()
    tokens = Counter()
    for d, t, lang, source, _ in rows:
        tokens[lang, source] += len(SPACED.findall(t))
    assert len(got) == len(rows)
    check(got, tokens, weights, sum(tokens.values()) if total is None else total, epochs, ["lang", "source"])
    assert not any(r.copies for r in got if r.source == "s5")


def test_same_seed_same_choice(spark):
    _, docs = table(spark)
    pick = lambda seed, parts: {r.doc_id for r in mixing.mixture(docs.repartition(parts), ["lang"], [{}], total=5000, max_epochs=1, seed=seed).where("copies > 0").collect()}
    assert pick(1, 2) == pick(1, 9) != pick(2, 2)


def test_awkward_rows(spark):
    docs = frame(spark).withColumnRenamed("n_chars", "copies")
    got = mixing.mixture(docs, ["lang", "source"], [{}, {}], max_epochs=2).collect()
    assert sorted(str((r.doc_id, r.n_tokens)) for r in got) == sorted(str((d, len(SPACED.findall(t or "")))) for d, t, *_ in awkward_docs())
    assert mixing.mixture(frame(spark, []), ["lang"], [{}]).collect() == []
    rows, some = table(spark)
    plan = mixing.mixture(some, ["lang"], [{"en": 9.0}], max_epochs=3, key="doc_id")
    out = Counter(r.doc_id for r in mixing.mixed_documents(some, plan, "doc_id").collect())
    assert out == Counter({r.doc_id: r.copies for r in plan.collect() if r.copies})


def test_rows_without_or_of_one_id(spark, monkeypatch):
    """Copies belong to rows: none is multiplied by others of its id, and none of them is one task's load."""
    rows = [(None, "a b"), (None, "a b"), (None, "c"), (5, "d e f")]
    keyed = spark.createDataFrame([(k, d, t, "en") for k, (d, t) in enumerate(rows)], "k long, doc_id long, text string, lang string")
    plan = mixing.mixture(keyed, ["lang"], [{}], max_epochs=1, key="k")
    assert sorted((r.k, r.doc_id, r.text) for r in mixing.mixed_documents(keyed, plan, "k").collect()) == [(k, d, t) for k, (d, t) in enumerate(rows)]
    monkeypatch.setattr(mixing, "LAST", 20)
    rows = [(None, "w " * 3, "en", "s", 1)] * 700 + [(1, f"w{k} " * (1 + k % 5), "en", "s", 1) for k in range(300)]
    tokens = sum(len(t.split()) for _, t, *_ in rows)
    got = mixing.mixture(frame(spark, rows), ["lang"], [{}], total=tokens // 2, max_epochs=1).collect()
    taken = sum(r.copies * r.n_tokens for r in got)
    assert len(got) == 1000 and tokens // 2 - 5 <= taken <= tokens // 2
