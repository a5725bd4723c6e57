"""The page tokenizer against the standard library's parser and on odd markup."""

import random
import time
from html.parser import HTMLParser

import pytest

from millrace.operators import pages
from millrace.operators.page_tokens import attributes, page_fields, tokens

ALL = tuple(pages.PAGE.values())


@pytest.mark.parametrize(
    "html,want",
    [
        ("<html lang=ko>", [None, "ko", None, None, [], ""]),
        ("<a href=/x>y</a><a name=top>z</a><A HREF='?a=1&amp;b&copy=2'>", [None, None, None, None, ["/x", "?a=1&b&copy=2"], "y z"]),
        ("<meta name=description content=short>", [None, None, None, "short", [], ""]),
        ("<meta property='Description' content=\"a > b\">x", [None, None, None, "a > b", [], "x"]),
        ('<!-- <a href="no"> --><script>"<a href=z>"</script ><style>h1{}</style>t', [None, None, None, None, [], "t"]),
        ("<title>a <b> &amp; c</title><h1>d<i>e</i>\n&nbsp;f</h1><h1>g</h1>", ["a <b> & c", None, "d e f", None, [], "a <b> & c d e f g"]),
        ("<h1><h1>in</h1> out</h1> more", [None, None, "in out", None, [], "in out more"]),
        ("<h1>open <a href>x", [None, None, "open x", None, [""], "open x"]),
        ("1 < 2 <3 a<b c", [None, None, None, None, [], "1 < 2 <3 a"]),
        ("<!-->x<!--->y<!-- z", [None, None, None, None, [], "x y"]),
        ("<html lang=''><p lang=fr><html lang=de>", [None, None, None, None, [], ""]),
        ("", [None, None, None, None, [], ""]),
        (None, [None] * 6),
    ],
)
def test_odd_markup(html, want):
    assert page_fields(html, ALL) == want


class Reference(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out = []

    def handle_starttag(self, tag, attrs):
        own = {}
        for k, v in attrs:
            own.setdefault(k, v or "")
        self.out.append((tag, own))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # a slash at the end says nothing in HTML

    def handle_endtag(self, tag):
        self.out.append(("/" + tag, {}))


def test_tags_and_attributes_equal_the_standard_parser():
    rng = random.Random(6)
    names, values = ["p", "a", "IMG", "h1", "div", "x-y"], ["v", "a > b", "it's", "", "1&amp;2", "ü/x"]
    for _ in range(400):
        parts = []
        for _ in range(rng.randint(0, 12)):
            kind = rng.random()
            if kind < 0.5:
                own = []
                for _ in range(rng.randint(0, 3)):
                    name, v = rng.choice(["href", "CLASS", "data-x", "id"]), rng.choice(values)
                    quote = rng.choice(['"', "'"]) if "'" not in v else '"'
                    own.append(rng.choice([f"{name}={quote}{v}{quote}", name, f"{name} = {quote}{v}{quote}", f"{name}=plain/1"]))
                parts.append(f"<{rng.choice(names)}{''.join(' ' + x for x in own)}{rng.choice(['', ' ', '/', ' /'])}>")
            elif kind < 0.7:
                parts.append(f"</{rng.choice(names)}{rng.choice(['', ' '])}>")
            else:
                parts.append(rng.choice(["text", " & more", "<!-- <p> -->", "<!doctype html>", "<script>a<b</script>", "1 < 2"]))
        html = "".join(parts).replace("plain/1/>", "plain/1 />")
        want = Reference()
        want.feed(html)
        want.close()
        got = [(t, {k: v.replace("&amp;", "&") for k, v in attributes(x).items()}) if kind == "start" else ("/" + t, {}) for kind, t, x in tokens(html) if kind in ("start", "end")]
        assert got == want.out, html


def test_time_grows_with_the_page():
    for html in ('<a href="' * 60_000, "<" * 200_000, "<!--" * 60_000, "<a b=" * 60_000, "<p " + "x='" * 60_000, "<title>" * 60_000, "<b>x</b>" * 60_000):
        began = time.time()
        page_fields(html, ALL)
        assert time.time() - began < 5
