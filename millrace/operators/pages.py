"""Fields out of web pages: one pass over the markup for flat fields, a parser for nested items."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.operators.page_tokens import Field, page_fields
from millrace.session import spread

# Elements that have no end tag.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def extract_fields(df: DataFrame, key: str, html: str, fields: Mapping[str, Field]) -> DataFrame:
    """``key`` and the named fields of each page, all found in one pass over its markup.

    A field is ("text", tag), ("attribute", tag, name), ("all", tag, name),
    ("meta", name) or ("visible",); see ``page_tokens.page_fields``.
    """
    wanted = list(fields.values())
    lists = pa.list_(pa.string())
    kinds = [lists if f[0] == "all" else pa.string() for f in wanted]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                rows = [page_fields(page.as_py(), wanted) for page in some.column(1)]
                columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.record_batch([some.column(0), *columns], names=["_key", *fields])

    names = {n: "array<string>" if f[0] == "all" else "string" for n, f in fields.items()}
    schema = f"`_key` {df.schema[key].dataType.simpleString()}, " + ", ".join(f"`{n}` {kind}" for n, kind in names.items())
    return spread(df.select(key, html)).mapInArrow(parse, schema).withColumnRenamed("_key", key)


PAGE = {
    "title": ("text", "title"),
    "lang": ("attribute", "html", "lang"),
    "heading": ("text", "h1"),
    "description": ("meta", "description"),
    "links": ("all", "a", "href"),
    "text": ("visible",),
}


def extract_page(df: DataFrame, key: str, html: str) -> DataFrame:
    """Title, language, first heading, description, links and visible text of each page."""
    return extract_fields(df, key, html, PAGE)


class _Items(HTMLParser):
    """Collects the wanted fields of every item element of one page.

    A field is the text, or an attribute, of the first element inside the item
    with the given tag and class ('' matches any class; tag '' is the item).
    """

    def __init__(self, item: tuple[str, str], fields: Sequence[tuple[str, str, str]]):
        super().__init__(convert_charrefs=True)
        self.item, self.fields = item, fields
        self.rows: list[list[str | None]] = []
        self.open: list[tuple[int, list[str | None]]] = []
        self.reading: list[tuple[int, list[str | None], int]] = []
        self.depth = 0

    @staticmethod
    def _fits(tag: str, attrs: dict, want_tag: str, want_class: str) -> bool:
        return tag == want_tag and (not want_class or want_class in (attrs.get("class") or "").split())

    def handle_starttag(self, tag, attributes):
        attrs = dict(attributes)
        self.depth += 1
        starts = self._fits(tag, attrs, *self.item)
        if starts:
            row: list[str | None] = [None] * len(self.fields)
            self.rows.append(row)
            self.open.append((self.depth, row))
        if self.open:
            row = self.open[-1][1]
            for i, (want_tag, want_class, what) in enumerate(self.fields):
                hit = starts if not want_tag else self._fits(tag, attrs, want_tag, want_class)
                if not hit or row[i] is not None:
                    continue
                if what == "text":
                    row[i] = ""
                    self.reading.append((self.depth, row, i))
                else:
                    row[i] = attrs.get(what)
        if tag in _VOID:
            self._leave()

    def _leave(self):
        self.reading = [r for r in self.reading if r[0] < self.depth]
        while self.open and self.open[-1][0] >= self.depth:
            self.open.pop()
        self.depth -= 1

    def handle_endtag(self, tag):
        if tag not in _VOID and self.depth > 0:
            self._leave()

    def handle_data(self, data):
        for _, row, i in self.reading:
            row[i] += data


def page_items(html: str | None, item: tuple[str, str], fields: Sequence[tuple[str, str, str]]) -> list[list[str | None]]:
    parser = _Items(item, fields)
    parser.feed(html or "")
    parser.close()
    return [[v.strip() if v is not None else None for v in row] for row in parser.rows]


def extract_items(df: DataFrame, key: str, html: str, item: tuple[str, str], fields: Mapping[str, tuple[str, str, str]]) -> DataFrame:
    """One row per item element of a page: ``(tag, class)`` and its fields ``(tag, class, 'text' or attribute)``.

    Nesting needs a parser, so this is one of the few Python steps; pages are
    independent, and each is handled in its own task row by row.
    """
    key_type = df.schema[key].dataType.simpleString()
    names, wanted = list(fields), list(fields.values())

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, n, *item_) for k, page in zip(batch[key], batch[html]) for n, item_ in enumerate(page_items(page, item, wanted))]
            yield pd.DataFrame(rows, columns=[key, "item", *names])

    schema = f"`{key}` {key_type}, item int, " + ", ".join(f"`{n}` string" for n in names)
    return df.select(key, html).mapInPandas(parse, schema)
