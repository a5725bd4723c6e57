"""TF-IDF term weights and keyword rankings.

Weight of a term in a document: count x (ln((1 + N) / (1 + df)) + 1), divided by
the length of the document's weight vector. Stop words, document-frequency
limits and the vocabulary size act before the length is taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.text import WORD, strip_html, strip_non_word, tokens
from millrace.operators.ordering import top_n_per_group
from millrace.session import pinned, scratch_path, spread


def combined_text(columns: Sequence[str]) -> Column:
    """Several text columns as one, tags and punctuation blanked."""
    return strip_non_word(strip_html(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])))


def _rows(df: DataFrame, doc: str, text: Column | str, by: Sequence[str], pattern: str, stop: Sequence[str]) -> DataFrame:
    """(by, doc, words) of each row."""
    t = F.col(text) if isinstance(text, str) else text
    words = tokens("_t", pattern)
    if stop:
        words = F.filter(words, lambda w: ~w.isin(list(stop)))
    return spread(df.select(*by, F.col(doc).alias("doc"), t.alias("_t"))).select(*by, "doc", words.alias("words"))


def _exploded(rows: DataFrame, by: Sequence[str], what: Column | str, out: str) -> DataFrame:
    """One row for each element. Outer, as a plain ``explode`` has its array tested, and so cut, below the shuffle first."""
    return rows.select(*by, "doc", F.explode_outer(what).alias(out)).where(F.col(out).isNotNull())


def term_counts(
    df: DataFrame, doc: str, text: Column | str, by: Sequence[str] = (), pattern: str = WORD, stop: Sequence[str] = ()
) -> DataFrame:
    """Occurrences of each term per document; terms are counted before they are shuffled."""
    words = _exploded(_rows(df, doc, text, by, pattern, stop), by, "words", "term")
    return words.groupBy(*by, "doc", "term").agg(F.count(F.lit(1)).alias("tf"))


def _several(df: DataFrame, doc: str, by: Sequence[str]) -> DataFrame:
    """Documents that have more than one row, written: Catalyst knows their size and broadcasts few, or none."""
    path = scratch_path(df.sparkSession, "several")
    df.select(*by, F.col(doc).alias("doc")).groupBy(*by, "doc").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n").write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _met(rows: DataFrame, several: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    """Rows of documents with several rows, or (``left_anti``) all others; null keys are equal."""
    same = F.lit(True)
    for c in [*by, "doc"]:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}"))
    return rows.alias("r").join(several.alias("s"), same, how)


def _counts(rows: DataFrame, several: DataFrame, by: Sequence[str], kept: DataFrame | None) -> DataFrame:
    """Occurrences (``tf``) of each term per document, of the ``kept`` terms only if given.

    A row that is a document of its own is counted where it is read: equal words
    stand side by side when sorted. Only the words of documents with several rows
    are shuffled to be counted.
    """

    def wanted(words: DataFrame) -> DataFrame:
        return words if kept is None else words.join(kept.select(*by, "term"), [*by, "term"], "left_semi")

    once = _met(rows, several, by, "left_anti").select(*by, "doc", F.sort_array("words").alias("words"))
    first = F.filter(F.transform("words", lambda w, i: i), lambda i: (i == 0) | (F.get("words", i) != F.get("words", i - 1)))
    once = once.select(*by, "doc", "words", first.alias("first"))
    runs = F.transform("first", lambda p, k: F.struct(F.get("words", p).alias("term"), (F.coalesce(F.get("first", k + 1), F.size("words")) - p).cast("long").alias("tf")))
    once = wanted(_exploded(once, by, runs, "_t").select(*by, "doc", "_t.*"))
    many = wanted(_exploded(_met(rows, several, by, "left_semi"), by, "words", "term"))
    return once.unionByName(many.groupBy(*by, "doc", "term").agg(F.count(F.lit(1)).alias("tf")))


def term_totals(rows: DataFrame, several: DataFrame | None, by: Sequence[str] = ()) -> DataFrame:
    """Occurrences (``_ttf``) and documents (``df``) of each term.

    A row that is a document of its own adds its words and its distinct words,
    which meet on the term alone and are combined before the shuffle. Only the
    words of documents with several rows are counted per document first.
    """
    by = list(by)
    if several is not None:
        many = _exploded(_met(rows, several, by, "left_semi"), by, "words", "term")
        many = many.groupBy(*by, "doc", "term").agg(F.count(F.lit(1)).alias("_a")).select(*by, "term", "_a", F.lit(1).cast("long").alias("_b"))
        rows = _met(rows, several, by, "left_anti")
    once = F.concat(
        F.transform("words", lambda w: F.struct(w.alias("term"), F.lit(1).cast("long").alias("_a"), F.lit(0).cast("long").alias("_b"))),
        F.transform(F.array_distinct("words"), lambda w: F.struct(w.alias("term"), F.lit(0).cast("long").alias("_a"), F.lit(1).cast("long").alias("_b"))),
    )
    terms = _exploded(rows, by, once, "_t").select(*by, "_t.*")
    if several is not None:
        terms = terms.unionByName(many)
    return terms.groupBy(*by, "term").agg(F.sum("_a").alias("_ttf"), F.sum("_b").alias("df"))


def vocabulary(
    totals: DataFrame,
    sizes: DataFrame,
    by: Sequence[str] = (),
    min_df: int = 1,
    max_df: float = 1.0,
    max_features: int | None = None,
) -> DataFrame:
    """Terms kept, with their document frequency and idf.

    The ``max_features`` most frequent terms are kept, the smaller term on ties.
    """
    by = list(by)
    if by:
        terms = totals.join(sizes, by)
    else:
        terms = totals.withColumn("n_docs", sizes.select("n_docs").scalar())
    terms = terms.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(float(max_df)) * F.col("n_docs")))
    if max_features is not None:
        order = [F.desc("_ttf"), F.asc("term")]
        terms = top_n_per_group(terms, by, order, max_features) if by else terms.orderBy(*order).limit(max_features)
    return terms.withColumn("idf", _idf()).drop("_ttf")


def _idf() -> Column:
    return F.log((1.0 + F.col("n_docs")) / (1.0 + F.col("df"))) + 1.0


def tfidf(
    df: DataFrame,
    doc: str,
    text: Column | str,
    by: Sequence[str] = (),
    pattern: str = WORD,
    stop: Sequence[str] = (),
    min_df: int = 1,
    max_df: float = 1.0,
    max_features: int | None = None,
) -> DataFrame:
    """Normalised weight of every kept term of every document (long sparse matrix).

    With ``by`` every group is a corpus of its own. Texts are not shuffled (but for
    tables of fewer files than cores): they are read once for the vocabulary and
    once for the counts, which are made where a text is read. Counts are shuffled
    twice, to their terms and back to their documents, as small whole numbers: weights are
    worked out behind the last shuffle. A vocabulary limited by ``max_features`` is
    written, and words outside of it are dropped before that.
    """
    by = list(by)
    rows = _rows(df, doc, text, by, pattern, stop)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_docs"))
    several = _several(df, doc, by)
    kept = vocabulary(term_totals(rows, None if several.isEmpty() else several, by), sizes, by, min_df, max_df, max_features)
    if max_features is not None:
        kept = pinned(kept)
    counts = _counts(rows, several, by, kept if max_features is not None else None)
    raw = counts.join(kept.drop("idf"), [*by, "term"]).repartition(*by, "doc").withColumn("_w", F.col("tf") * _idf())
    # one document's terms, so the window is bounded by the document
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(*by, "doc")))
    return raw.select(*by, "doc", "term", "tf", "df", "n_docs", (F.col("_w") / length).alias("weight"))


def keywords(
    df: DataFrame, doc: str, text: Column | str, k: int = 30, by: Sequence[str] = (), agg: str = "sum", scale: int = 6, **controls
) -> DataFrame:
    """The ``k`` terms with the largest summed or mean weight, per group if asked.

    The mean counts documents without the term as 0.
    """
    if agg not in ("sum", "mean"):
        raise ValueError(agg)
    by = list(by)
    w = tfidf(df, doc, text, by, **controls)
    total = F.sum("weight")
    score = total if agg == "sum" else total / F.max("n_docs")
    scored = w.groupBy(*by, "term").agg(F.bround(score, scale).alias("score"), F.max("df").alias("df"))
    order = [F.desc("score"), F.asc("term")]
    return top_n_per_group(scored, by, order, k) if by else scored.orderBy(*order).limit(k)
