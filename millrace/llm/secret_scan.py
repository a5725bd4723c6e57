"""Secrets in texts: fixed forms, and random strings by two character Markov models.

Stretches of identifier characters are scored by the log-likelihood ratio of two
first-order Markov models, one of random strings and one of ordinary
identifiers. The labelled samples come from the corpus itself: values inside the
fixed forms are random strings, words outside of them are ordinary. Runs end at
``=``, ``/`` and fixed forms; of a run of any length the best-scoring stretches
whose ratio exceeds ``LOG_ODDS`` become spans of kind ``random``. All steps are
built-in expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.shared import only

# The forms, in the order in which equal starts are listed.
FORMS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",  # equal to runs of [0-9a-f]+ of 24 and more
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
RUN = "[A-Za-z0-9+_-]"
ORDINARY = r"[A-Za-z_-]{6,}"
SAMPLE = 20_000
LOG_ODDS = 14.0  # one run in a million is taken to be a secret
SIDE = len(ALPHABET) + 1
SPANS = "array<struct<start:long,end:long,value:string>>"


def _all(text: Column, pattern: str | Column, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(group))


def _with_spans(d: DataFrame, name: str, pattern: str | Column, group: int = 0) -> DataFrame:
    """Adds ``name``: start, end (code points) and value of all matches, leftmost and non-overlapping.

    The gaps between the matches give the places; a text without a match costs one search.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    text, found = F.col("text"), F.rlike("text", pattern)
    d = d.withColumns({
        "_whole": F.when(found, _all(text, pattern)), "_value": F.when(found, _all(text, pattern, group)),
        "_gaps": F.when(found, F.split(text, pattern, -1)),
    })
    empty = F.array().cast(SPANS)

    def step(acc: Column, i: Column) -> Column:
        start = acc["at"] + F.length(F.get("_gaps", i))
        end = start + F.length(F.get("_whole", i))
        span = F.struct(start.alias("start"), end.alias("end"), F.get("_value", i).alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    begin = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))
    spans = F.aggregate(F.sequence(F.lit(0), F.size("_whole") - 1), begin, step, lambda a: a["out"])
    return d.withColumn(name, F.when(F.col("_whole").isNotNull(), spans).otherwise(empty)).drop("_whole", "_value", "_gaps")


def _with_forms(d: DataFrame) -> DataFrame:
    for kind, pattern in FORMS.items():
        d = _with_spans(d, kind, pattern, 2 if kind == "assign" else 0)
        d = d.withColumn(kind, F.filter(kind, _at_least(LEAST[kind])))
    return d


def _at_least(n: int):
    return lambda span: F.length(span["value"]) >= n


def _symbols(word: Column) -> Column:
    """Places of the characters in ``ALPHABET``, 0 for others."""
    return F.transform(F.split(word, ""), lambda c: F.when(c == "", 0).otherwise(F.instr(F.lit(ALPHABET), c)))


@dataclass
class MarkovRatio:
    """Log ratio of the transition probabilities, by (symbol, next symbol)."""

    weights: list[float]

    def run(self) -> str:
        """Runs of the least length that can exceed ``LOG_ODDS``, whatever they are made of."""
        best, n = self.weights[:SIDE], 1
        while max(best) <= LOG_ODDS and n < 64:
            best, n = [max(b + self.weights[k * SIDE + s] for k, b in enumerate(best)) for s in range(SIDE)], n + 1
        return f"{RUN}{{{n},}}"

    def table(self) -> Column:
        return F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")

    def score(self, word: Column) -> Column:
        """Score of the best stretch: the running maximum alone, as most words go no further."""
        table = self.table()
        step = lambda a, s: F.struct(s.alias("last"), F.greatest(a["sum"] + F.get(table, a["last"] * SIDE + s), F.get(table, s)).alias("sum"), F.greatest(a["best"], a["sum"]).alias("best"))
        begin = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
        return F.aggregate(_symbols(word), begin, step, lambda a: F.greatest(a["best"], a["sum"]))

    def stretches(self, word: Column) -> Column:
        """begin, end of the best-scoring stretches above ``LOG_ODDS``, apart from each other.

        A stretch begins where a fresh start scores better than going on; one
        above ``LOG_ODDS`` ends at its highest sum once the sum has fallen by as much.
        """
        table = self.table()

        def closed(a: Column) -> Column:
            mine = F.array(F.struct(a["begin"].alias("begin"), a["end"].alias("end")))
            return F.when(a["best"] > LOG_ODDS, F.concat(a["out"], mine)).otherwise(a["out"])

        def step(a: Column, s: Column) -> Column:
            fresh, on = F.get(table, s), a["sum"] + F.get(table, a["last"] * SIDE + s)  # symbol 0 also stands for the start
            at = a["at"] + 1
            new, better = (on < fresh) | (a["best"] > LOG_ODDS) & (a["best"] - on >= LOG_ODDS), on > a["best"]
            return F.struct(
                s.alias("last"), at.alias("at"), F.when(new, fresh).otherwise(on).alias("sum"), F.when(new, a["at"]).otherwise(a["begin"]).alias("begin"),
                F.when(new | better, at).otherwise(a["end"]).alias("end"), F.when(new, fresh).otherwise(F.greatest(on, a["best"])).alias("best"),
                F.when(new, closed(a)).otherwise(a["out"]).alias("out"),
            )

        none = F.array().cast("array<struct<begin:int,end:int>>")
        begin = F.struct(*(F.lit(v).alias(k) for k, v in {"last": 0, "at": 0, "sum": 0.0, "begin": 0, "end": 0, "best": 0.0}.items()), none.alias("out"))
        return F.aggregate(_symbols(word), begin, step, closed)


def _transitions(words: DataFrame) -> list[float]:
    """Smoothed log probabilities of the next symbol, from the words of ``words``."""
    moves = words.select(_symbols(F.col("word")).alias("s")).select(F.explode(F.transform("s", lambda x, i: F.when(i > 0, F.get("s", i - 1)).otherwise(0) * SIDE + x)).alias("move"))
    count = [1.0] * (SIDE * SIDE)
    for r in moves.groupBy("move").count().collect():
        count[r.move] += r["count"]
    totals = [sum(count[k * SIDE : (k + 1) * SIDE]) for k in range(SIDE)]
    return [math.log(c / totals[k // SIDE]) for k, c in enumerate(count)]


def fit_markov(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> MarkovRatio:
    """Train both models.

    Random strings are the values of the fixed forms, of which ``SAMPLE`` are
    taken in the order of a hash; ordinary identifiers are the words outside of
    the forms in all documents. Every distinct string counts once.
    """
    d = only(docs, doc_id=doc_id, text=text).where("text is not null")
    forms = "|".join(f"(?:{p})" for p in FORMS.values())
    form = F.col("text").rlike(forms)
    values = _with_forms(d.where(form)).select(F.explode(F.concat(*FORMS)).alias("s")).select(F.col("s.value").alias("word")).distinct()
    outside = F.when(form, F.regexp_replace("text", forms, " ")).otherwise(F.col("text"))
    ordinary = d.select(F.explode(_all(outside, ORDINARY)).alias("word")).distinct()
    random, usual = _transitions(values.orderBy(F.xxhash64("word"), "word").limit(SAMPLE)), _transitions(ordinary)
    return MarkovRatio([a - b for a, b in zip(random, usual)])


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: MarkovRatio | None = None) -> DataFrame:
    """Per row: doc_id, assign, access, hex, random: the spans of each kind.

    Spans hold start and end in code points, end exclusive, and the value. A null
    or empty text has none; a text of any length is searched whole, in time that
    grows with its matches squared; of spans of one kind that overlap the first
    stays. Null ids are carried along; repeated rows get equal results; an empty
    table gives none; other columns are ignored.
    """
    model = model or fit_markov(docs, doc_id, text)
    d = only(docs, doc_id=doc_id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    d = _with_forms(d).withColumn("_base", F.concat(*FORMS))
    # fixed forms end a run: blanks of equal length take their places
    blank = lambda t, b: F.overlay(t, F.repeat(F.lit(" "), (b["end"] - b["start"]).cast("int")), (b["start"] + 1).cast("int"), (b["end"] - b["start"]).cast("int"))
    d = d.withColumn("text", F.when(F.size("_base") > 0, F.aggregate("_base", F.col("text"), blank)).otherwise(F.col("text")))
    lettered = lambda w: F.filter(model.stretches(w), lambda x: F.substring(w, x["begin"] + 1, x["end"] - x["begin"]).rlike("[A-Za-z]"))
    words = F.array_distinct(_all(F.col("text"), model.run()))
    d = d.withColumn("_odd", F.filter(words, lambda w: model.score(w) > LOG_ODDS))
    # only the places of those runs are looked for
    ends = F.concat(F.lit(f"(?<!{RUN})(?:"), F.replace(F.array_join("_odd", "|"), F.lit("+"), F.lit(r"\+")), F.lit(f")(?!{RUN})"))
    d = _with_spans(d.withColumn("_ends", F.when(F.size("_odd") > 0, ends)), "random", F.col("_ends"))

    def cut(s: Column) -> Column:
        part = lambda x: F.struct((s["start"] + x["begin"]).alias("start"), (s["start"] + x["end"]).alias("end"), F.substring(s["value"], x["begin"] + 1, x["end"] - x["begin"]).alias("value"))
        return F.transform(lettered(s["value"]), part)

    return d.withColumn("random", F.when(F.size("random") > 0, F.flatten(F.transform("random", cut))).otherwise(F.col("random"))).select("doc_id", *FORMS, "random")


def secret_digest(found: DataFrame) -> DataFrame:
    """doc_id, counts of the fixed forms, base_sha256 and all spans as text."""
    def listed(n: int, kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("n"), F.concat_ws(":", F.lit(kind), s["start"], s["end"]).alias("s")))

    def joined(*kinds: str) -> Column:
        return F.concat_ws(",", F.sort_array(F.concat(*(listed(n, k) for n, k in enumerate(kinds))))["s"])

    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in FORMS), F.sha2(joined(*FORMS), 256).alias("base_sha256"),
        joined(*FORMS, "random").alias("spans"), F.size("random").cast("long").alias("n_random"),
    )
