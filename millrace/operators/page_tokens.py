"""Markup of one page read in one pass: tags, attributes, comments, raw text.

Attributes may be quoted or not, in any order and case, and hold ``>``; comments
and the text of scripts and styles are neither tags nor text. Matching is
possessive, so a page takes time in proportion to its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html import unescape
from html.entities import html5

_ATTRIBUTE = r"""[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?)?"""
ATTRIBUTE = re.compile(_ATTRIBUTE, re.A)
MARKUP = re.compile(
    rf"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*+(?:>|\Z)|/([A-Za-z][^\s/>]*+)[^>]*+(?:>|\Z)|([A-Za-z][^\s/>]*+)((?:{re.sub(r"[(](?![?])", "(?:", _ATTRIBUTE)})*+)[\s/]*+(?:>|\Z))""",
    re.A | re.S,
)
REFERENCE = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);?")
BLANKS = re.compile("[ \t\n\x0b\x0c\r\xa0]+")
# elements whose text holds no tags; of the second kind it is text all the same
HIDDEN, PLAIN = {"script", "style", "xmp", "iframe", "noembed", "noframes"}, {"title", "textarea"}
_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.A | re.I) for name in HIDDEN | PLAIN}

# ("text", tag), ("attribute", tag, name), ("all", tag, name), ("meta", name) or ("visible",)
Field = tuple[str, ...]


def attribute_value(value: str) -> str:
    """Character references of an attribute as characters; a name without its semicolon is none before ``=``."""
    if "&" not in value:
        return value

    def character(m: re.Match) -> str:
        ref = m[0]
        if ref[1] != "#" and ref[-1] != ";" and (ref[1:] not in html5 or value[m.end() : m.end() + 1] == "="):
            return ref
        return unescape(ref)

    return REFERENCE.sub(character, value)


def attributes(inside: str) -> dict[str, str]:
    """Names in lower case and values; of equal names the first counts."""
    out: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(inside):
        out.setdefault(name.lower(), a or b or c)
    return out


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """("text", "", text), ("start", tag, what is inside), ("end", tag, "") and ("comment", "", "") in order."""
    at = 0
    while m := MARKUP.search(html, at):
        if m.start() > at:
            yield "text", "", html[at : m.start()]
        at = m.end()
        if m[1]:
            yield "end", m[1].lower(), ""
        elif m[2]:
            tag = m[2].lower()
            yield "start", tag, m[3]
            if tag in _END:
                end = _END[tag].search(html, at)
                stop = end.start() if end else len(html)
                if tag in PLAIN and stop > at:
                    yield "text", "", html[at:stop]
                at = stop
        else:
            yield "comment", "", ""
    if at < len(html):
        yield "text", "", html[at:]


def plain(pieces: Sequence[str]) -> str:
    return BLANKS.sub(" ", "".join(pieces)).strip(" ")


def page_fields(html: str | None, fields: Sequence[Field]) -> list:
    """The fields of a page: a text or attribute of the first element that has it, all of an attribute, the visible text.

    Missing and empty ones are null, except that all values of an attribute and
    the visible text of a page may be empty; a null page has nulls only.
    """
    if html is None:
        return [None] * len(fields)
    found: list = [[] if f[0] == "all" else None for f in fields]
    texts: dict[str, list[str]] = {f[1]: [] for f in fields if f[0] == "text"}
    reading: dict[str, int] = {}  # depth of the elements whose text is being read
    done: set[str] = set()
    visible: list[str] = []
    wanted: dict[str, list[int]] = {}
    for i, f in enumerate(fields):
        if f[0] in ("attribute", "all", "meta"):
            wanted.setdefault("meta" if f[0] == "meta" else f[1], []).append(i)
    for kind, tag, inside in tokens(html):
        if kind == "text":
            text = unescape(inside) if "&" in inside else inside
            visible.append(text)
            for name in reading:
                texts[name].append(text)
            continue
        visible.append(" ")
        for name in reading:
            texts[name].append(" ")
        if kind == "end":
            if tag in reading:
                reading[tag] -= 1
                if not reading[tag]:
                    del reading[tag]
                    done.add(tag)
        elif kind == "start":
            if tag in reading:
                reading[tag] += 1
            elif tag in texts and tag not in done:
                reading[tag] = 1
            if tag in wanted:
                own = attributes(inside)
                for i in wanted[tag]:
                    f = fields[i]
                    if f[0] == "meta":
                        if found[i] is None and f[1] in (own.get("name", "").lower(), own.get("property", "").lower()) and "content" in own:
                            found[i] = attribute_value(own["content"])
                    elif f[2] in own:
                        if f[0] == "all":
                            found[i].append(attribute_value(own[f[2]]))
                        elif found[i] is None:
                            found[i] = attribute_value(own[f[2]])
    for i, f in enumerate(fields):
        if f[0] == "text":
            found[i] = plain(texts[f[1]])
        elif f[0] == "visible":
            found[i] = plain(visible)
        if f[0] not in ("all", "visible"):
            found[i] = found[i] or None
    return found
