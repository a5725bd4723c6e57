"""Mixing sources to target weights along a tree, with epochs drawn per leaf.

The tree is given by columns, such as domain, language and source. A budget of
tokens goes down from the root: children share it by weight, a child cannot take
more than its documents give in ``max_epochs`` epochs, and what it cannot take
goes to its siblings by weight. As a subtree's capacity is that of all its
leaves, only what the siblings cannot take either is left to the next level up.

The share of a node among its siblings is min(capacity, s * weight) with one s
for all of them. With the siblings ordered by capacity / weight, s is the
greatest of (budget - capacities before) / (weights from here on).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.llm.shared import only, written
from millrace.operators.joins import salted_join

WORD = r"[^\x20\x09-\x0D]+"
CELLS = 4096  # cells of a permutation in each narrowing step
LAST = 65_536  # documents of a leaf that one task sums one by one


def _node(column: str) -> Column:
    """A node's name; null is a node of its own."""
    return F.when(F.col(column).isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col(column).cast("string")))


def _shares(nodes: DataFrame, parents: list[str], name: str, weights: Mapping[str, float], default: float) -> DataFrame:
    """Adds ``share``: each node's part of its parent's ``budget``."""
    weight = F.lit(float(default))
    for value, w in weights.items():
        weight = F.when(F.col(name) == f"={value}", F.lit(float(w))).otherwise(weight)
    order = W.partitionBy(*parents).orderBy(F.col("capacity") / F.col("weight"), name)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    onwards = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    weighted = nodes.withColumn("weight", weight).where("weight > 0").withColumn("s", (F.col("budget") - before) / onwards)
    scale = F.max("s").over(W.partitionBy(*parents))
    return weighted.withColumn("share", F.least("capacity", scale * F.col("weight"))).drop("s", "weight", "budget")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: Sequence[Mapping[str, float]], total: float, max_epochs: int, default_weight: float) -> DataFrame:
    """Budgets of the leaves (levels..., tokens), from the root down.

    Window partitions hold the children of one node, never documents.
    """
    given = leaves.withColumn("capacity", (F.col("tokens") * max_epochs).cast("double"))
    budgets, path = None, []
    for level, level_weights in zip(levels, weights):
        parents, path = path, [*path, level]
        nodes = given.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.join(budgets, parents) if budgets is not None else nodes.withColumn("budget", F.lit(float(total)))
        budgets = _shares(nodes, parents, level, level_weights, default_weight).select(*path, F.col("share").alias("budget"))
    return leaves.join(budgets, path, "left").fillna(0.0, ["budget"])


def _prefix(docs: DataFrame, leaf: list[str]) -> DataFrame:
    """Adds ``taken``: whether a document lies in its leaf's prefix of ``rest`` tokens.

    Documents are ordered by the hash ``h``, rows of equal hash cells by the hash
    ``g`` of the row. Token sums of hash cells find the cell in which the prefix
    ends, cells of that cell the same again, until no such cell holds more than
    ``LAST`` documents; only those are summed one by one.
    """
    parts = [F.shiftrightunsigned(h, by).bitwiseAND(CELLS - 1).cast("int") for h in ("h", "g") for by in (52, 40)]
    for n, cell in enumerate(parts):
        docs = docs.withColumn("cell", cell)
        sums = docs.where("open").groupBy(*leaf, "cell").agg(F.sum("n_tokens").alias("cell_tokens"), F.count("*").alias("n"), F.first("skipped").alias("skipped"), F.first("rest").alias("rest"))
        upto = F.col("skipped") + F.sum("cell_tokens").over(W.partitionBy(*leaf).orderBy("cell"))
        # a row for each cell: written, so that the plan stays short
        sums = written(sums.withColumn("upto", upto).select(*leaf, "cell", "upto", (F.col("upto") - F.col("cell_tokens")).alias("cell_skipped"), "n", "rest"), "cells")
        docs = docs.join(sums.drop("n", "rest"), [*leaf, "cell"], "left")
        inside = F.col("open") & (F.col("upto") <= F.col("rest"))
        docs = docs.withColumn("taken", F.col("taken") | inside).withColumn("skipped", F.when(F.col("open"), F.col("cell_skipped")).otherwise(F.col("skipped")))
        docs = docs.withColumn("open", F.col("open") & (F.col("upto") > F.col("rest")) & (F.col("cell_skipped") < F.col("rest"))).drop("cell", "upto", "cell_skipped")
        if n and sums.where(f"upto > rest and cell_skipped < rest and n > {LAST}").isEmpty():
            break
    order = ["h", "g"] if n < 2 else ["g", "h"]
    run = F.sum("n_tokens").over(W.partitionBy(*leaf).orderBy(*order, "n").rowsBetween(W.unboundedPreceding, 0))
    last = docs.where("open").withColumn("taken", F.col("skipped") + run <= F.col("rest"))
    return docs.where("not open").unionByName(last)


def mixture(
    docs: DataFrame, levels: Sequence[str], weights: Sequence[Mapping[str, float]], *, doc_id: str = "doc_id", text: str = "text",
    total: int | None = None, max_epochs: int = 4, default_weight: float = 1.0, seed: int = 0, key: str | None = None,
) -> DataFrame:
    """Per row: doc_id, the levels, n_tokens, copies: how often the mixture holds the document.

    With ``key``, a column of whole numbers that tells rows apart, ``row_key`` follows.

    Tokens are runs of anything but ASCII white space. A leaf with budget b and t
    tokens gives b // t whole epochs and of one more, in the order of a hash of
    seed, epoch, id and text, the longest prefix of documents within the rest.
    Without ``total`` the mixture is as large as the corpus. Null and empty texts
    have no tokens; a text of any length is counted whole and taken whole or not
    at all; null level values are nodes of their own; rows without an id, or of one
    id, are told apart by their texts; equal rows are interchangeable; a weight of
    0 drops a node; an empty table gives none; other columns are ignored.
    """
    named = {f"level_{k}": c for k, c in enumerate(levels)}
    leaf = list(named)
    d = only(docs, doc_id=doc_id, text=text, **named, **({"n": key} if key else {}))
    number = F.col("n").cast("long") if key else F.monotonically_increasing_id()
    d = d.select("doc_id", F.xxhash64("text").alias("body"), number.alias("n"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"), *(_node(c).alias(c) for c in leaf))
    d = written(d, "tokens")
    leaves = d.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens"))
    if total is None:
        total = d.agg(F.sum("n_tokens")).first()[0] or 0
    budgets = leaf_budgets(leaves, leaf, weights, total, max_epochs, default_weight)
    # a hair's breadth above keeps whole epochs whole in floating point
    budget = F.floor(F.col("budget") + 1e-6)
    epochs = F.when(F.col("tokens") > 0, F.floor(budget / F.col("tokens"))).otherwise(F.lit(0)).cast("long")
    budgets = written(budgets.select(*leaf, epochs.alias("epochs"), (budget - epochs * F.col("tokens")).alias("rest")), "budgets")
    # a hot leaf's documents meet its budget in as many tasks as a shuffle has
    d = salted_join(d, budgets, leaf, "n")
    d = d.withColumns({"h": F.xxhash64(F.lit(seed), F.col("epochs"), F.col("doc_id"), F.col("body")), "g": F.xxhash64(F.lit(seed), F.col("epochs"), F.col("n"))})
    # a whole corpus with no tokens has nothing to open
    d = d.withColumns({"taken": F.lit(False), "open": F.col("rest") > 0, "skipped": F.lit(0).cast("long")})
    d = _prefix(d, leaf)
    value = lambda c: F.when(F.col(c) != "null", F.substring(c, 2, 1 << 30))
    return d.select("doc_id", *(value(c).alias(name) for c, name in named.items()), "n_tokens", (F.col("epochs") + F.col("taken").cast("long")).alias("copies"), *([F.col("n").alias("row_key")] if key else []))


def mixed_documents(docs: DataFrame, plan: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs``, each as often as ``plan`` says: the mixture of ``docs`` by the same ``key``.

    A row meets its own copies only, whatever its id or text. Rows whose key is
    null are in no plan row and go.
    """
    times = plan.where("copies > 0").select("row_key", F.col("copies").cast("int").alias("copies"))
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("row_key"), F.struct("*").alias("row"))
    return rows.join(times, "row_key").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
