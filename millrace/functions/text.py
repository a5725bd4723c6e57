"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from millrace.functions.columns import col

# Word characters of any script; plain ``\w`` is ASCII-only on the JVM.
WORD = r"[\p{L}\p{N}_]+"
WORD2 = r"[\p{L}\p{N}_]{2,}"


def rx_contains(c: Column | str, pattern: str) -> Column:
    """Case-insensitive regex search; null counts as no match."""
    return F.coalesce(F.rlike(col(c), F.lit(f"(?iu){pattern}")), F.lit(False))


def any_of(c: Column | str, words: Sequence[str]) -> Column:
    """True when the text holds any of the words; null counts as no match."""
    hits = [F.contains(col(c), F.lit(w)) for w in words]
    return F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False))


def kw_count(c: Column | str, words: Sequence[str]) -> Column:
    """Non-overlapping occurrences of each word, added up, ignoring case."""
    t = F.lower(F.coalesce(col(c), F.lit("")))
    counts = [(F.length(t) - F.length(F.replace(t, F.lit(w.lower()), F.lit("")))) / F.lit(len(w)) for w in words]
    return reduce(lambda a, b: a + b, counts).cast("int")


def search_hit(cols: Sequence[Column | str], query: str) -> Column:
    """Every blank-separated token of the query occurs in the joined columns."""
    text = F.lower(F.concat_ws(" ", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in cols]))
    return reduce(lambda a, b: a & b, [F.contains(text, F.lit(t.lower())) for t in query.split()], F.lit(True))


def first_word(c: Column) -> Column:
    return F.nullif(F.try_element_at(F.split(F.trim(c), r"\s+"), F.lit(1)), F.lit(""))


def leading_brand(c: Column | str, skip: Sequence[str] = ()) -> Column:
    """Brand in front of a product title.

    ``[brand] ...`` gives the bracket's content unless it is a skip word or a
    single character; then, and without a bracket, the first word that follows.
    """
    t = col(c)
    bracket = F.trim(F.regexp_extract(t, r"^\[(.*?)\]", 1))
    rest = F.regexp_replace(t, r"^\[.*?\]", "")
    usable = (F.length(bracket) > 1) & (~bracket.isin(list(skip)) if skip else F.lit(True))
    return F.when(usable, bracket).otherwise(first_word(rest))


def num_unit(c: Column | str, pattern: str) -> tuple[Column, Column]:
    """Groups 1 and 2 of the first match as number and unit; null without one."""
    number = F.nullif(F.regexp_extract(col(c), pattern, 1), F.lit("")).try_cast("int")
    unit = F.nullif(F.regexp_extract(col(c), pattern, 2), F.lit(""))
    return number, unit


def strip_html(c: Column | str) -> Column:
    """Tags replaced by a blank."""
    return F.regexp_replace(col(c), r"<[^>]*>", " ")


def strip_non_word(c: Column | str) -> Column:
    """Everything but letters, digits, underscores and blanks replaced by a blank."""
    return F.regexp_replace(col(c), r"[^\p{L}\p{N}_\s]", " ")


def tokens(c: Column | str, pattern: str = WORD) -> Column:
    """All matches of the pattern in the lower-cased text, in order."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(pattern), F.lit(0))


def domain(c: Column | str, default: str) -> Column:
    """Host of a URL without ``www.``; the default when there is none."""
    host = F.regexp_extract(F.coalesce(col(c), F.lit("")), r"https?://([^/]+)", 1)
    return F.when(host != "", F.replace(host, F.lit("www."), F.lit(""))).otherwise(F.lit(default))


def clean_url(c: Column | str, default: str, blocked: Column | None = None, fillers: Sequence[str] = ()) -> Column:
    """Trimmed URL, or the default when it is missing, one of the lower-case ``fillers``, not http, or blocked."""
    u = F.trim(F.coalesce(col(c), F.lit("")))
    bad = F.lower(u).isin("", *fillers) | ~F.startswith(u, F.lit("http"))
    if blocked is not None:
        bad = bad | F.coalesce(blocked, F.lit(False))
    return F.when(bad, F.lit(default)).otherwise(u)


def build_url(platform: Column | str, text: Column | str, templates: dict[str, str], default: str) -> Column:
    """Search URL of the first platform key found in the platform name.

    ``templates`` maps a key to a URL prefix; the text is appended encoded.
    """
    name = F.lower(F.coalesce(col(platform), F.lit("")))
    prefix = F.lit(default)
    for key, url in reversed(list(templates.items())):
        prefix = F.when(F.contains(name, F.lit(key)), F.lit(url)).otherwise(prefix)
    return F.concat(prefix, F.url_encode(F.coalesce(col(text).cast("string"), F.lit(""))))
