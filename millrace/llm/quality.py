"""Quality rules: text statistics and a likelihood ratio of hashed n-grams.

The likelihood ratio compares two multinomials over ``BUCKETS`` hashed word and
punctuation n-grams (one and two tokens): one counted on trusted documents, one
on the whole corpus. A document's score is its mean log ratio per n-gram, so
long and short texts are judged alike. Every document whose score is below one
fixed threshold is rejected; the threshold is set from the trusted documents.
All documents and all labels take part in the counts and in the threshold.

Everything is built-in expressions; hashed counts have a fixed size, so the
weights that come back to the driver do too.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.shared import discard, only, roughly_in, roughly_marked, written
from millrace.operators.quantiles import quantiles

BUCKETS = 10_000
PRIOR = 100_000
LOST_SHARE = 0.001
MARGIN = 0.03
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _bucket(*tokens: Column) -> Column:
    return F.pmod(F.xxhash64(*tokens), F.lit(BUCKETS)).cast("int")


@dataclass
class QualityModel:
    """Log ratios by bucket, and the least score that is kept."""

    weights: list[float]
    threshold: float

    def column(self, spark: SparkSession) -> Column:
        """The weights as one array, read where rows are scored.

        As a constant they would stand in full in every plan and every text of a
        plan that the driver makes and keeps.
        """
        table = spark.createDataFrame([(self.weights,)], "weights array<double>").coalesce(1)
        return written(table, "weights").scalar()


def _tokens(docs: DataFrame, *kept: str) -> DataFrame:
    return docs.select(*kept, _all(F.coalesce("text", F.lit("")), TOKEN).alias("tokens"))


def _score() -> Column:
    """Mean log ratio over ``tokens`` by ``weights``; a text without tokens scores 0."""
    weights = F.col("weights")

    def one(total: Column, i: Column) -> Column:
        token, following = F.get("tokens", i), F.get("tokens", i + 1)
        return total + F.get(weights, _bucket(token)) + F.when(following.isNull(), 0.0).otherwise(F.get(weights, _bucket(token, following)))

    n = F.size("tokens")
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), one) / (2 * n - 1)).otherwise(0.0)


def _counts(docs: DataFrame) -> dict[int, tuple[int, int]]:
    """Occurrences of each bucket in all documents and in those with a ``mark``."""
    n = F.size("tokens")
    pairs = F.transform(F.slice("tokens", 1, F.greatest(n - 1, F.lit(0))), lambda t, i: _bucket(t, F.get("tokens", i + 1)))
    buckets = _tokens(docs, "mark").select("mark", F.explode(F.concat(F.transform("tokens", lambda t: _bucket(t)), pairs)).alias("bucket"))
    return {r.bucket: (r.n, r.marked) for r in buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if("mark").alias("marked")).collect()}


def fit_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", label_id: str = "doc_id") -> QualityModel:
    """Count both multinomials and set the threshold.

    The corpus side counts every document. Of all documents labelled 1 one half,
    by a hash of the id, is counted as trusted, shrunk towards the corpus by
    ``PRIOR`` n-grams, and the other half sets the threshold: ``MARGIN`` below
    the score that all but ``LOST_SHARE`` of its documents with enough tokens
    reach. Those were not counted as trusted, just as the documents to be judged
    were not. Without trusted documents nothing is rejected.

    Ids are never gathered, however many there are. A broadcast bitmap of their
    hashes marks documents in the pass that counts the corpus; the others it
    marks by chance are found by their ids alone, and what they added is taken
    off again. Of the held-out half ids meet scores, not texts.
    """
    good = only(labels, id=label_id, label=label).where("label = 1 and id is not null").select(F.col("id").cast("long").alias("doc_id")).distinct()
    good = written(good.withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))), "trusted")
    counted, held = (good.where(F.col("half") == h).select("doc_id") for h in (0, 1))
    own = only(docs, doc_id=doc_id, text=text)

    counts = _counts(roughly_marked(own, "doc_id", counted, "mark"))
    chance = written(roughly_in(own.select("doc_id"), "doc_id", counted).join(counted, "doc_id", "left_anti").distinct(), "chance")
    # the ids are distinct; a semi join would be moved below the bitmap and shuffle all texts
    wrong = _counts(roughly_in(own, "doc_id", chance).join(chance, "doc_id").withColumn("mark", F.lit(True)))
    raw, trusted = [1] * BUCKETS, [0] * BUCKETS
    for bucket, (n, marked) in counts.items():
        raw[bucket] += n
        trusted[bucket] += marked - wrong.get(bucket, (0, 0))[0]
    n_raw, n_trusted = sum(raw), sum(trusted)
    if not n_trusted:
        discard(docs.sparkSession, good, chance)
        return QualityModel([0.0] * BUCKETS, 0.0)
    model = QualityModel([math.log((t * n_raw / r + PRIOR) / (n_trusted + PRIOR)) for t, r in zip(trusted, raw)], 0.0)

    long = F.size("tokens") >= MIN_WORDS
    tokens = _tokens(roughly_in(own, "doc_id", held), "doc_id").withColumn("weights", model.column(docs.sparkSession))
    scores = tokens.select("doc_id", F.when(long, _score()).alias("score"))
    scores = written(scores.join(held, "doc_id").select("score"), "scores")
    cut = quantiles(scores, "score", [LOST_SHARE]).first()
    discard(docs.sparkSession, good, chance, scores)
    return QualityModel(model.weights, min(0.0, cut.q[0] - MARGIN) if cut else -math.inf)


def quality(docs: DataFrame, labels: DataFrame | None, doc_id: str = "doc_id", text: str = "text", model: QualityModel | None = None, carry: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    A document is kept unless a text rule (``base_failed``) or the threshold
    rejects it. Without a ``model`` one is fitted on ``docs`` and ``labels``.
    With ``carry`` the struct ``row`` holds all columns of ``docs``.

    ``n_repeat_words`` counts the words inside any three-word window that occurs
    twice or more. Windows are compared by 64-bit hashes within one text. A null
    text has no words; a text of any length is judged whole; a score equal to the
    threshold is kept. A null doc_id is carried along; repeated rows get equal
    results; an empty table gives none; other columns are ignored.
    """
    model = model or fit_quality(docs, labels, doc_id, text)
    row = ["row"] if carry else []
    d = docs.select(*([F.struct("*").alias("row")] if carry else []), F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    d = d.select(*row, "doc_id", _all(F.col("text"), TOKEN).alias("tokens"), _all(F.col("text"), WORD).alias("words"), lines.alias("lines"), F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"), model.column(docs.sparkSession).alias("weights"))
    n = F.size("words")
    windows = F.transform(F.slice("words", 1, F.greatest(n - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    d = d.select(
        *row, "doc_id", n.cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), windows.alias("h"), _score().alias("score"),
    )
    # equal windows side by side; only texts that have any are sorted
    repeats = F.size(F.array_distinct("h")) < F.size("h")
    d = d.withColumn("s", F.when(repeats, F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    same = lambda e, k: F.get("s", k)["x"] == e["x"]
    twice = F.filter("s", lambda e, k: F.coalesce(same(e, k - 1), F.lit(False)) | F.coalesce(same(e, k + 1), F.lit(False)))
    d = d.drop("h").withColumn("at", F.sort_array(F.transform(twice, lambda e: e["i"])))
    covered = F.transform("at", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("at", k + 1) - p, F.lit(3))))
    d = d.withColumn("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))).drop("s", "at")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return d.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= model.threshold))
