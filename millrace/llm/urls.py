"""URL filters: host and path rules, and boosted trees on lexical features for the rest.

URLs that a rule fits are the labelled examples; gradient-boosted trees learn
from a bounded number of them and judge every URL that no rule fits. Features
and rules are built-in expressions, the trees are Spark's own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.shared import only, written

TRAINING_URLS = 10_000
ROUNDS, DEPTH, SEED = 20, 4, 7
SMOOTHING = 10.0
# Last labels of hosts are counted in so many buckets, apart for so many folds of sites.
BUCKETS, FOLDS = 4096, 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse_rules(lines: str) -> list[Rule]:
    """Rules from lines such as ``block example.com/en/``."""
    out = []
    for line in filter(None, map(str.strip, lines.splitlines())):
        verdict, _, name = line.partition(" ")
        host, _, path = name.strip().partition("/")
        out.append(Rule(host, "/" + path, verdict))
    return out


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


def with_rules(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """(page_id, url) with host, path and the longest fitting rule's name and verdict."""
    d = pages.withColumns({"host": F.translate(_part(F.col("url"), 1), UPPER, LOWER), "path": _part(F.col("url"), 2)})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):  # a longer rule goes around the shorter ones
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, r.name).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return d.withColumns({"rule": rule, "ruled": verdict})


def _fold(host: Column) -> Column:
    """The fold of a host, by its last two labels, so all of a site is in one."""
    return F.pmod(F.xxhash64(F.substring_index(host, ".", -2)), F.lit(FOLDS)).cast("int")


def _bucket(host: Column) -> Column:
    """Where the host's last label is counted."""
    return F.pmod(F.xxhash64(F.substring_index(host, ".", -1)), F.lit(BUCKETS)).cast("int")


FEATURES = ["length", "host_length", "path_length", "depth", "labels", "digits", "host_digits", "hyphens", "entropy", "parameters", "fragment", "extension", "suffix_rate", "suffix_size"]


def with_features(d: DataFrame) -> DataFrame:
    """Lexical features of url, host and path as doubles."""
    url, n = F.coalesce("url", F.lit("")), F.greatest(F.length(F.coalesce("url", F.lit(""))), F.lit(1))
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern))
    share = lambda c: (F.length(url) - F.length(F.replace(url, c))) / n
    entropy = F.aggregate(F.array_distinct(F.filter(F.split(url, ""), lambda c: c != "")), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    columns = {
        "length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"),
        "depth": count(F.col("path"), "/[^/]"), "labels": count(F.col("host"), r"[^.]+"),
        "digits": count(url, "[0-9]") / n, "host_digits": count(F.col("host"), "[0-9]"), "hyphens": count(F.col("host"), "-"),
        "entropy": entropy, "parameters": count(query, "[^&]+"), "fragment": url.contains("#"), "extension": F.col("path").rlike(r"\.[A-Za-z0-9]+$"),
    }
    return d.withColumns({k: v.cast("double") for k, v in columns.items()})


@dataclass
class UrlModel:
    """Trees, and counts of labelled URLs by bucket of the last label and fold of the site.

    A URL, learnt from or judged, gets the blocked share of the other folds, so
    its own site's labels are never among its features.
    """

    trees: GBTClassificationModel | None
    suffixes: DataFrame
    base_rate: float

    def with_suffixes(self, d: DataFrame) -> DataFrame:
        # BUCKETS rows at most
        d = d.withColumn("bucket", _bucket(F.col("host"))).join(F.broadcast(self.suffixes), "bucket", "left")
        others = F.filter(F.coalesce("folds", F.array().cast("array<struct<fold:int,n:bigint,blocked:double>>")), lambda x: x["fold"] != _fold(F.col("host")))
        total = lambda name: F.aggregate(others, F.lit(0.0), lambda a, x: a + x[name])
        rate = (total("blocked") + SMOOTHING * self.base_rate) / (total("n") + SMOOTHING)
        return d.withColumns({"suffix_rate": rate, "suffix_size": F.log1p(total("n"))}).drop("bucket", "folds")

    def block_probability(self, d: DataFrame) -> DataFrame:
        d = self.with_suffixes(with_features(d))
        if self.trees is None:
            return d.withColumn("p_block", F.lit(self.base_rate))
        ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(d)
        return self.trees.transform(ready).withColumn("p_block", vector_to_array("probability")[1])


def fit_urls(ruled: DataFrame) -> UrlModel:
    """Train on the ``TRAINING_URLS`` first labelled URLs by a hash of the URL.

    Suffix statistics count all labelled URLs, smoothed towards the overall share:
    one row for each of ``BUCKETS`` buckets, however many hosts there are. With labels of one kind only there are no trees and the share decides.
    """
    labelled = ruled.where("ruled is not null").withColumn("label", (F.col("ruled") == "block").cast("double"))
    rate = labelled.agg(F.avg("label")).first()[0] or 0.0
    cells = labelled.groupBy(_bucket(F.col("host")).alias("bucket"), _fold(F.col("host")).alias("fold")).agg(F.count("*").alias("n"), F.sum("label").alias("blocked"))
    # written, as training and judging both read it
    suffixes = written(cells.groupBy("bucket").agg(F.collect_list(F.struct("fold", "n", "blocked")).alias("folds")), "suffixes")
    model = UrlModel(None, suffixes, rate)
    if rate in (0.0, 1.0):
        return model
    sample = labelled.select("url", "host", "path", "label").orderBy(F.xxhash64("url"), "url").limit(TRAINING_URLS)
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(model.with_suffixes(with_features(sample)))
    model.trees = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, seed=SEED).fit(ready.select("features", "label"))
    return model


def url_verdicts(pages: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url", model: UrlModel | None = None) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, p_block.

    A null URL or one without ``://`` has an empty host and path, fits no rule
    and is judged by the trees on what features it has. URLs of any length are
    judged whole. Of rules of equal length one that comes later wins; a
    probability of one half allows. Null ids are carried along, repeated rows get
    equal results, an empty table gives none, other columns are ignored.
    """
    ruled = with_rules(only(pages, page_id=page_id, url=url), rules)
    model = model or fit_urls(ruled)
    judged = F.when(F.col("p_block") > 0.5, "block").otherwise("allow")
    return model.block_probability(ruled).select("page_id", "host", "path", "rule", F.coalesce("ruled", judged).alias("verdict"), "p_block")
