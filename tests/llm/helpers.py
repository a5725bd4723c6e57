"""Brute-force versions of the corpus operators and awkward tables."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def awkward_docs():
    """Nulls, empty, blank, very long and repeated texts, exact copies and odd characters."""
    long = " ".join(f"w{k * 7919 % 5003}" for k in range(30_000))
    base = " ".join(f"base{k}" for k in range(60))
    near = base.replace("base30", "other")
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\f\r "), (4, long), (5, base), (6, base), (7, near), (7, near), (8, "one two"), (9, "one  TWO"), (10, "One two three"),
        (None, base), (None, None), (11, "é É ñandú    x \x1c y"), (12, long + " tail"), (13, "!!! ... ,,, a.b,c. don't I'LL <|endoftext|> <|EndOfText|> x"),
        (14, base + "\n" + base), (15, "line one of many words here\n" * 40), (16, "\n\n\n"), (17, "日本語 テキスト。 カタカナ é \U0001f600\U0001f600 ok"),
    ]
    return [(d, t, "en", f"src{(d or 0) % 3}", None if t is None else len(t)) for d, t in rows]


def frame(spark, rows=None, parts=3):
    return spark.createDataFrame(awkward_docs() if rows is None else rows, DOCS).repartition(parts)


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r[:1]) + (str(r),))


# near duplicates


def shingles(text):
    words = SPACED.findall((text or "").translate(LOWER))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def components(docs):
    """[(doc_id, text)] to {doc_id: component} by comparing all pairs that share a shingle."""
    sets = [(d, shingles(t)) for d, t in docs if d is not None]
    holders, common, parent = defaultdict(list), Counter(), {d: d for d, _ in sets}
    for n, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(n)
    for own in holders.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                common[a, b] += 1

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a][1]) + len(sets[b][1]) - n):
            x, y = sorted((root(sets[a][0]), root(sets[b][0])))
            parent[y] = x
    return {d: root(d) for d in parent}


# secrets

FORMS = {
    "assign": (re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 1, 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile("[0-9a-f]+"), 0, 24),
}


def base_spans(text):
    found = [(m.start(), n, f"{kind}:{m.start()}:{m.end()}") for n, (kind, (p, group, least)) in enumerate(FORMS.items()) for m in p.finditer(text or "") if len(m[group]) >= least]
    return [s for *_, s in sorted(found)]


# quality


def statistics(text):
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    count = Counter(windows)
    covered = {p for k, w in enumerate(windows) if count[w] > 1 for p in (k, k + 1, k + 2)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


# benchmark passages


def alnum_words(text):
    return ALNUM.findall((text or "").translate(LOWER))


def benchmark_windows(items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        words = alnum_words(text)
        n = min(size, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[k : k + n])].add(item)
    return windows


def passages(text, windows):
    words, hit, items = alnum_words(text), set(), set()
    for n in {len(w) for w in windows}:
        for k in range(len(words) - n + 1):
            if own := windows.get(tuple(words[k : k + n])):
                hit.update(range(k, k + n))
                items |= own
    return len(words), hit, items


# token files


@lru_cache
def tokenizer(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_rows(docs, path):
    """[(doc_id, text)] to [(doc_id, start, n, crc)] in id order."""
    out, start = [], 0
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer(path).encode(t or "", add_special_tokens=False).ids + [1]
        out.append((d, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out
