import re
from collections import Counter

from helpers import awkward_docs, frame
from millrace.llm import licenses
from millrace.llm.queries import QUERIES


def words(text):
    return re.findall(licenses.WORD, text.lower().replace("licence", "license"))


def grams(text):
    w = words(text)
    return Counter(zip(w, w[1:]))


TEMPLATES = [(name, grams(t)) for name, texts in licenses.TEMPLATES.items() for t in texts]


def matches(text):
    text = text or ""
    text = text.lower().replace("licence", "license")
    units = set(text.split("\n")) | {p for p in re.split(r"\n[ \t]*\n", text) if "\n" in p} | ({text} if "\n" in text else set())
    best = [max((2 * (g & t).total() / (g.total() + t.total()), name) for name, t in TEMPLATES) for u in units if (g := grams(u))]
    return sorted(((round(d, 9), n) for d, n in best if d >= licenses.THRESHOLD), reverse=True)


def test_query(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op5_licenses"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = matches(texts[r.doc_id])
        assert r.n_units == len(want) and r.licenses == ",".join(sorted({n for _, n in want}))
        assert (r.best, r.best_dice and round(r.best_dice, 9)) == ((want[0][1], want[0][0]) if want else (None, None))


def test_awkward_rows(spark):
    mit, apache = licenses.TEMPLATES["MIT"][1], licenses.TEMPLATES["Apache-2.0"][1]
    split = mit.replace(", ", ",\n")
    rows = awkward_docs() + [(50, mit, "x", "s", 1), (51, f"head\n\n{split}\n\ntail", "x", "s", 1), (52, apache.upper().replace("LICENSE", "LICENCE"), "x", "s", 1), (53, mit[: len(mit) // 3], "x", "s", 1), (54, split, "x", "s", 1)]
    got = licenses.license_matches(frame(spark, rows).withColumnRenamed("lang", "grams").withColumnRenamed("source", "units")).collect()
    assert len(got) == len(rows)
    want = sorted(str((d, matches(t))) for d, t, *_ in rows)
    assert sorted(str((r.doc_id, [(round(m.dice, 9), m.name) for m in r.matches])) for r in got) == want
    found = {r.doc_id: {m.name for m in r.matches} for r in got}
    assert found[50] == found[51] == found[54] == {"MIT"} and found[52] == {"Apache-2.0"} and not found[53]
    assert licenses.license_matches(frame(spark, [])).collect() == []
