"""One query for each corpus operator, and its SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import chat, decontaminate, hilbert_shards, licenses, line_dedup, mixing, near_dedup, periodic_runs, quality, secret_scan, token_files, turn_align, urls
from millrace.sources.readers import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COMPONENTS = rf"""with recursive w as (select doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
  s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as x from w),
  n as (select doc_id, count(*) as n from s group by 1),
  p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b using (x) where a.doc_id < b.doc_id group by all),
  l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
  e as (select a, b from l union all select b, a from l),
  r(doc_id, c) as (select doc_id, doc_id from documents union select e.b, r.c from r join e on e.a = r.doc_id),
  m as (select doc_id, min(c) as component_id from r group by 1)
  select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept from m left join n using (doc_id)"""

PASSAGES = rf"""with d as (select doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
  b as (select item_id, w, least(10, len(w)) as k from (select item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark) where len(w) > 0),
  v as (select distinct item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as x from b),
  p as (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from d, (select distinct k from v)),
  h as (select doc_id, i, k, item_id from (select *, array_to_string(w[i:i + k - 1], ' ') as x from p) join v using (k, x)),
  c as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + k)) as j from h) group by 1),
  t as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, cast(item_id as varchar) as item from h) group by 1)
  select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
  from d left join c using (doc_id) left join t using (doc_id)"""


# a byte's CRC-32 table by its rule, and the checksum of a text's UTF-8 bytes
CRC_TABLE = """list_transform(range(256), lambda n: list_reduce(range(8), lambda a, k: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end, n::bigint))"""


def crc_sql(text: str, table: str) -> str:
    return f"""xor(list_reduce(list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::bigint), lambda a, b: xor(a >> 8, {table}[(xor(a, b) & 255) + 1]), 4294967295::bigint), 4294967295)"""


SHARDS, SHARD_DIMS = 40, ["lang", "source", "n_chars"]


def shards_sql(dims: list[str], count: int, bits: int = hilbert_shards.BITS) -> str:
    """Cells by counts of values, places by the steps of the curve, runs by row numbers."""
    digits, following = hilbert_shards.curve_steps(len(dims))
    cells = 1 << bits
    bounds = [
        f"""b{k} as (select max(v) as b from (select v, (sum(n) over (order by v) - 1) * {cells} // sum(n) over () as c
        from (select {c} as v, count(*) as n from documents where {c} is not null group by 1)) group by c),
  l{k} as (select coalesce(list(b), []) as l from (select b from b{k} where b < (select max(b) from b{k})))"""
        for k, c in enumerate(dims)
    ]
    codes = ", ".join(f"coalesce(len(list_filter(l{k}.l, lambda b: b < {c})), 0) as c{k}" for k, c in enumerate(dims))
    corner = " + ".join(f"((c{k} >> s & 1) << {k})" for k in range(len(dims)))
    size = 1 << len(dims)
    return f"""with t as (select {CRC_TABLE} as crc, {digits} as digit, {following} as next),
  {", ".join(bounds)},
  d as (select doc_id, strlen(coalesce(text, '')) + {hilbert_shards.OVERHEAD} as size, {crc_sql("coalesce(text, '')", "t.crc")} as text_crc32, {codes}
        from documents, t, {", ".join(f"l{k}" for k in range(len(dims)))}),
  p as (select doc_id, size, text_crc32, list_reduce(range({bits - 1}, -1, -1), lambda a, s:
        {{state: t.next[a.state * {size} + {corner} + 1]::bigint, place: a.place * {size} + t.digit[a.state * {size} + {corner} + 1]::bigint}}, {{state: 0::bigint, place: 0::bigint}}).place as place from d, t),
  n as (select *, row_number() over (order by place, text_crc32, doc_id, size) - 1 as i, count(*) over () as n from p),
  s as (select *, (2 * i + 1) * {count} // (2 * n) as shard from n)
  select doc_id, size, text_crc32, 'rows' as law, shard, row_number() over (partition by shard order by i) - 1 as slot, null as grown_shard, place from s"""


def turns_sql() -> str:
    """Damage, first faults, and the cheapest repair, a turn at a time over the states of the grammar.

    A way is (cost, audit, repaired lines); the least of two ways is the cheaper
    one, or the one with the ASCII-least audit. No two ways into a state have equal audits.
    """
    none = "{c: 1000000000::bigint, a: '', l: []::varchar[]}"

    def more(way: str, cost: str, edit: str, line: str | None = None) -> str:
        lines = f"{way}.l" if line is None else f"list_append({way}.l, {line})"
        return f"{{c: {way}.c + {cost}, a: {way}.a || '{edit}', l: {lines}}}"

    def least(*ways: str) -> str:
        return ways[0] if len(ways) == 1 else f"least({', '.join(ways)})"

    def inserted(way: str, *letters: str) -> str:
        for z in letters:
            way = more(way, "5", "I", "'user:'" if z == "u" else "'assistant:'")
        return way

    # ways in which a turn may come to stand for a letter: from each state, with what is inserted before it
    to_u = [inserted("w.b"), inserted("w.s"), inserted("w.a"), inserted("w.u", "a")]
    to_a = [inserted("w.u"), inserted("w.b", "u"), inserted("w.s", "u"), inserted("w.a", "u")]
    # insertions before a turn that goes
    gone = {"b": ["w.b"], "s": ["w.s"], "u": ["w.u", *(inserted(x, "u") for x in ("w.b", "w.s", "w.a")), inserted("w.u", "a", "u")]}
    gone["a"] = ["w.a", inserted("w.u", "a"), *(inserted(x, "u", "a") for x in ("w.b", "w.s", "w.a"))]

    def stands(ways: list[str], z: str, name: str) -> list[str]:
        line = "x.r || ':' || x.t"
        return [f"case when x.k is null then {none} when x.i = '{z}' then {more(w, 'x.k', 'K', line)} else {more(w, 'x.k + 1', 'R', f"'{name}:' || x.t")} end" for w in ways]

    step = {
        "b": [more(w, "2", "D") for w in gone["b"]],
        "s": [more(w, "2", "D") for w in gone["s"]] + [f"case when x.k is not null and x.i = 's' then {more('w.b', 'x.k', 'K', "x.r || ':' || x.t")} else {none} end"],
        "u": [more(w, "2", "D") for w in gone["u"]] + stands(to_u, "u", "user"),
        "a": [more(w, "2", "D") for w in gone["a"]] + stands(to_a, "a", "assistant"),
    }
    fold = "{" + ", ".join(f"{s}: {least(*ways)}" for s, ways in step.items()) + "}"
    start = f"{{b: {{c: 0::bigint, a: '', l: []::varchar[]}}, s: {none}, u: {none}, a: {none}}}"
    ends = least("w.b", "w.a", inserted("w.u", "a"), inserted("w.s", "u", "a"))
    key = "coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')"
    return rf"""with t as (select {CRC_TABLE} as crc),
  h as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc_sql(key, "t.crc")} % 20 as h from conversations, t),
  d as (select conv_id, turn, case when h = 4 then 'user' else role end as r, case when h = 1 then '' when h = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as t,
        unnest(case when h = 3 then [0, 1] else [0] end) as copy from h where h <> 0),
  o as (select *, row_number() over (partition by conv_id order by turn nulls first, r, t, copy) as n from d),
  f as (select *, case when not regexp_matches(t, '[^ 	-]') then 'b' when row_number() over (partition by conv_id, r, t order by n) > 1 then 'd'
        when not regexp_matches(t, '[.!?][ 	-]*$') then 't' else '' end as f, lag(r) over (partition by conv_id order by n) as before from o),
  g as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (f = 'b') as blank, count(*) filter (f = 'd') as duplicate,
        count(*) filter (f = 't') as truncated, count(*) filter (before is not null and left(before, 1) || left(r, 1) not in ('su', 'ua', 'au')) as illegal,
        list({{i: left(r, 1), r: r, t: t, k: case f when 't' then 5 when '' then 0 end}} order by n) as turns from f group by conv_id),
  w as (select *, list_reduce(turns, lambda w, x: {fold}, {start}) as w from g),
  e as (select *, {ends} as e from w)
  select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  coalesce(e.e.c, 0) as cost, coalesce(e.e.a, '') as audit, sha256(coalesce(array_to_string(e.e.l, chr(10)), '')) as repaired_sha256
  from (select distinct conv_id from conversations) c left join e on c.conv_id is not distinct from e.conv_id"""


@query("op1_near_duplicates", COMPONENTS)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, folder, "documents"))


@query("op2_secrets")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_digest(secret_scan.secrets(read_table(spark, folder, "documents")))


@query("op3_quality_rules")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.quality(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


@query("op4_line_chunks")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, folder, "documents"))


@query("op5_licenses")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.license_matches(read_table(spark, folder, "documents"))
    names = F.array_join(F.array_sort(F.array_distinct(F.col("matches")["name"])), ",")
    return found.select("doc_id", F.size("matches").cast("long").alias("n_units"), names.alias("licenses"), F.get("matches", F.lit(0))["name"].alias("best"), F.get("matches", F.lit(0))["dice"].alias("best_dice"))


# the mixture's tree: four domains of five sources each, their languages, the sources themselves
DOMAIN_WEIGHTS = {"books": 0.3, "code": 0.1, "forum": 0.2, "web": 0.4}
LANGUAGE_WEIGHTS = {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0}


def with_domain(docs: DataFrame) -> DataFrame:
    number = F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int") % 4
    return docs.withColumn("domain", F.get(F.array(*map(F.lit, ["web", "forum", "books", "code"])), number))


@query("op6_mixture")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_domain(read_table(spark, folder, "documents"))
    return mixing.mixture(docs, ["domain", "lang", "source"], [DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS, {}], max_epochs=4, seed=6)


@query("op7_benchmark_passages", PASSAGES)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@query("op8_token_files")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_files(read_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_chat_repair")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(read_table(spark, folder, "conversations"))


URL_RULES = """
allow com/
block example.com/en/
allow www.example.com/en/
block net/es/
block net/fr/
"""


@query("op10_url_verdicts")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return urls.url_verdicts(read_table(spark, folder, "pages"), urls.parse_rules(URL_RULES))


@query("op11_hilbert_shards", shards_sql(SHARD_DIMS, SHARDS))
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return hilbert_shards.shard_documents(read_table(spark, folder, "documents"), SHARD_DIMS, SHARDS)


@query("op12_periodic_runs")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = periodic_runs.planted(read_table(spark, folder, "documents"))
    return periodic_runs.run_digest(periodic_runs.periodic_runs(docs))


@query("op13_turn_structure", turns_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return turn_align.structure_report(read_table(spark, folder, "conversations"))
