"""Queries: text and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.operators import aggregates as A, cleaning, pages as P, rules as R, tfidf as K
from millrace.plans.registry import Tables, query, rnd

LETTERS2 = r"[\p{L}\p{N}_]{2,}"


def tfidf_sql(
    docs: str, by: str = "", pattern: str = r"[\p{L}\p{N}_]+", stop=(), min_df=1, max_df=1.0, max_features=None, agg="sum", k=30, weights=False
) -> str:
    b = f"{by}, " if by else ""
    using = f"({b} term)"
    part = f"partition by {by}" if by else ""
    words = f"where term not in ({', '.join(repr(w) for w in stop)})" if stop else ""
    cut = f"qualify row_number() over ({part} order by ttf desc, term) <= {max_features}" if max_features else ""
    sizes = "t join s using (" + by + ")" if by else "t cross join s"
    score = rnd("sum(w / l)") if agg == "sum" else rnd("sum(w / l) / max(n)")
    tail = (
        f"select {b} doc, term, tf, {rnd('w / l')} as weight from w join l using ({b} doc)"
        if weights
        else f"""select {b} term, score, df from (select {b} term, {score} as score, max(df) as df from w join l using ({b} doc) group by {b} term)
        qualify row_number() over ({part} order by score desc, term) <= {k}"""
    )
    return f"""with docs as ({docs}),
      tok as (select {b} doc, unnest(regexp_extract_all(lower(text), '{pattern}')) as term from docs),
      c as (select {b} doc, term, count(*) as tf from tok {words} group by all),
      s as (select {b} count(*) as n from docs {f"group by {by}" if by else ""}),
      t as (select {b} term, count(*) as df, sum(tf) as ttf from c group by all),
      v as (select t.*, n from {sizes} where df >= {min_df} and df <= {max_df} * n {cut}),
      w as (select {b} doc, term, tf, df, n, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) as w from c join v using {using}),
      l as (select {b} doc, sqrt(sum(w * w)) as l from w group by all)
      {tail}"""


DOCS = "select doc_id as doc, text from documents"


@query("tx_01_tfidf_sum", tfidf_sql(DOCS, pattern=LETTERS2, max_features=100))
def _(t: Tables):
    return K.keywords(t.documents, "doc_id", "text", 30, pattern=LETTERS2, max_features=100)


@query("tx_01_tfidf_weights", tfidf_sql(DOCS, max_features=200, weights=True))
def _(t: Tables):
    w = K.tfidf(t.documents, "doc_id", "text", max_features=200)
    return w.select("doc", "term", "tf", F.bround("weight", 6).alias("weight"))


PAGES = r"""select page_id as doc, regexp_replace(regexp_replace(url || ' ' || html, '<[^>]*>', ' ', 'g'), '[^\p{L}\p{N}_\s]', ' ', 'g') as text from pages"""


@query("tx_02_tfidf_mean", tfidf_sql(PAGES, pattern=LETTERS2, max_features=100, agg="mean"))
def _(t: Tables):
    return K.keywords(t.pages, "page_id", K.combined_text(["url", "html"]), 30, agg="mean", pattern=LETTERS2, max_features=100)


@query("tx_03_tfidf_controls", tfidf_sql(DOCS, stop=("the", "of", "que"), min_df=2, max_df=0.3, max_features=150, k=50))
def _(t: Tables):
    return K.keywords(t.documents, "doc_id", "text", 50, stop=("the", "of", "que"), min_df=2, max_df=0.3, max_features=150)


@query("tx_03_tfidf_min_df", tfidf_sql(DOCS, min_df=2, max_df=0.9))
def _(t: Tables):
    """An unlimited vocabulary."""
    return K.keywords(t.documents, "doc_id", "text", 30, min_df=2, max_df=0.9)


@query("tx_04_tfidf_by_group", tfidf_sql("select lang, doc_id as doc, text from documents", by="lang", max_features=100, agg="mean", k=15))
def _(t: Tables):
    return K.keywords(t.documents, "doc_id", "text", 15, by=["lang"], agg="mean", max_features=100)


@query(
    "tx_05_tfidf_union",
    tfidf_sql(
        "select 'd' || doc_id as doc, text from documents union all select 'c' || conv_id || '-' || turn, text from conversations", max_features=100, agg="mean"
    ),
)
def _(t: Tables):
    a = t.documents.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc"), "text")
    b = t.conversations.select(F.concat(F.lit("c"), F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))).alias("doc"), "text")
    return K.keywords(cleaning.union_all(a, b), "doc", "text", 30, agg="mean", max_features=100)


@query(
    "tx_06_keyword_score",
    """select doc_id, score, score > 0 as has_keyword from (select doc_id, cast((length(lower(text)) - length(replace(lower(text), 'sion', ''))) / 4
       + (length(lower(text)) - length(replace(lower(text), 'und', ''))) / 3 as int) as score from documents)""",
)
def _(t: Tables):
    return R.keyword_index(t.documents.select("doc_id", "text"), X.kw_count("text", ["sion", "und"])).select("doc_id", "score", "has_keyword")


UNESCAPE = "replace(replace(replace(replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"


def tag_sql(tag: str) -> str:
    inner = f"regexp_replace(regexp_extract(html, '(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>', 1), '<[^>]*>', ' ', 'g')"
    return f"nullif(trim(regexp_replace({UNESCAPE.format(x=inner)}, '\\s+', ' ', 'g')), '')"


BARE = r"regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')"


@query(
    "tx_07_extract_page",
    rf"""select page_id, {tag_sql('title')} as title, nullif(regexp_extract(html, '(?is)<html\s[^>]*?lang=["'']([^"'']*)["'']', 1), '') as lang, {tag_sql('h1')} as heading,
        'A &amp; "B"' as description, array_to_string(list_prepend('?a=1&b=2', regexp_extract_all(html, '<a\s[^>]*?href=["'']([^"'']*)["'']', 1)), ' ') as links,
        md5('© ' || trim(regexp_replace({UNESCAPE.format(x=BARE)}, '\s+', ' ', 'g'))) as text_md5 from pages""",
)
def _(t: Tables):
    # upper case, other orders, look-alike attributes and character references
    odd = """<META data-content="no" CONTENT='A &amp;amp; "B"' NAME="description"><A data-href="x" HREF="?a=1&amp;b=2">&copy;&#160;</A>"""
    out = P.extract_page(t.pages.select("page_id", F.concat(F.lit(odd), "html").alias("html")), "page_id", "html")
    return out.withColumns({"links": F.array_join("links", " "), "text_md5": F.md5("text")}).drop("text")


ODD_PAGE = """<html lang=ko><!-- <a href="no"> --><script>var z = '<a href="z">';</script><meta name=description content="a > b"><a href=/x title='>"'>go</a><br/>"""


@query(
    "tx_07_extract_odd_page",
    rf"""select page_id, {tag_sql('title')} as title, 'ko' as lang, {tag_sql('h1')} as heading, 'a > b' as description,
        array_to_string(list_prepend('/x', regexp_extract_all(html, '<a\s[^>]*?href=["'']([^"'']*)["'']', 1)), ' ') as links,
        md5('go ' || trim(regexp_replace({UNESCAPE.format(x=BARE)}, '\s+', ' ', 'g'))) as text_md5 from pages""",
)
def _(t: Tables):
    # attributes without quotes and with > in them, tags in comments and scripts
    out = P.extract_page(t.pages.select("page_id", F.concat(F.lit(ODD_PAGE), "html").alias("html")), "page_id", "html")
    return out.withColumns({"links": F.array_join("links", " "), "text_md5": F.md5("text")}).drop("text")


@query(
    "tx_07_extract_items",
    r"""select page_id, cast(i - 1 as int) as item, href[i] as href, label[i] as label from (select page_id, href, label, unnest(range(1, len(href) + 1)) as i from (
        select page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) as href, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) as label from pages))""",
)
def _(t: Tables):
    return P.extract_items(t.pages, "page_id", "html", ("li", ""), {"href": ("a", "", "href"), "label": ("a", "", "text")})


@query(
    "tx_08_domain_share",
    f"""with d as (select replace(regexp_extract(url, 'https?://([^/]+)', 1), 'www.', '') as domain from pages)
        select domain, count(*) as n, {rnd('count(*) * 100.0 / (select count(*) from d)')} as pct from d group by 1 order by n desc, domain limit 10""",
)
def _(t: Tables):
    return A.value_counts(t.pages.select(X.domain("url", "other").alias("domain")), "domain", 10, share=True)
