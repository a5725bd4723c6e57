"""Files that are read piece by piece: feature collections and the members of archives."""

import io
import json
import random
import zipfile

import pytest

from millrace.sources import readers


def feature(rng, k):
    text = "".join(rng.choice(['"', "\\", "{", "}", "[", "]", "é", "가", "x", "\n", '"features":[']) for _ in range(rng.randint(0, 30)))
    ring = [[rng.random(), rng.random()] for _ in range(rng.randint(1, 5))]
    return {"type": "Feature", "properties": {"k": str(k), text: text, "deep": {"features": [{"no": 1}]}}, "geometry": {"type": "Polygon", "coordinates": [ring]}}


def documents(rng, n):
    for _ in range(n):
        features = [feature(rng, k) for k in range(rng.randint(0, 6))]
        doc = {"name": "features", "crs": {"features": [{"x": 1}]}, "list": [[1], {"features": [{}]}], "features": features, "tail": ["features", [{}]]}
        yield doc, features


@pytest.mark.parametrize("chunk", [1, 2, 7, 64, 1 << 20])
@pytest.mark.parametrize("form", ["lines", "array", "indented"])
def test_elements_of_documents(chunk, form):
    rng = random.Random(chunk)
    docs = list(documents(rng, 8))
    if form == "array":
        text = json.dumps([d for d, _ in docs])
    else:
        text = "\n".join(json.dumps(d, indent=1 if form == "indented" else None, ensure_ascii=form == "lines") for d, _ in docs)
    got = [json.loads(e) for e in readers._elements(io.BytesIO(text.encode()).read, b'"features"', chunk)]
    assert got == [f for _, features in docs for f in features]


def test_broken_documents():
    cut = b'{"features":[{"a":1},{"b":'
    with pytest.raises(ValueError, match="ends before"):
        list(readers._elements(io.BytesIO(cut).read, b'"features"', 4))
    with pytest.raises(ValueError, match="not opened"):
        list(readers._elements(io.BytesIO(b"{}}").read, b'"features"', 4))
    assert list(readers._elements(io.BytesIO(b'\xef\xbb\xbf{"features":[null,{"a":1},[{}]]}').read, b'"features"', 4)) == [b'{"a":1}']
    assert list(readers._elements(io.BytesIO(b"").read, b'"features"', 4)) == []


def test_one_document_is_never_held_whole():
    """64 MB of features are read with less than a megabyte at hand."""
    one = b'{"type":"Feature","properties":{"k":"' + b"x" * 1000 + b'"},"geometry":null},'
    parts = iter([b'{"features":[', *[one] * 64_000, b'{"type":"Feature"}]}', b""])
    assert sum(len(e) for e in readers._elements(lambda size: next(parts), b'"features"', 1 << 16)) > 64_000_000


def test_both_ways_agree(spark, tmp_path):
    docs = [d for d, _ in documents(random.Random(5), 40)]
    (tmp_path / "a.json").write_text("\n".join(json.dumps(d) for d in docs))
    (tmp_path / "empty.json").write_text("")
    rows = lambda whole: sorted((sorted(r.properties.items()), r.geometry_type, r.coordinates) for r in readers.read_features(spark, str(tmp_path / "*.json"), whole).collect())
    assert rows(True) == rows(False) != []


def test_members_are_tasks(spark, tmp_path):
    rng, want = random.Random(1), []
    for name in ("a", "b"):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            for m in range(3):
                lines = [f"{name}{m}{k},{rng.randint(0, 9)}" for k in range(50)]
                want += [tuple(line.split(",")) for line in lines]
                z.writestr(f"{m}.csv", "k,v\n" + "\n".join(lines))
                z.writestr(f"{m}.md", "k,v\nno,0\n")
    got = readers.read_zipped_csv(spark, str(tmp_path / "*.zip"), ".csv", "k string, v string")
    assert sorted(map(tuple, got.collect())) == sorted(want)
    one = readers.read_zipped_csv(spark, str(tmp_path / "a.zip"), ".csv", "k string, v string")
    tasks = one.rdd.glom().map(lambda rows: {r.k[:2] for r in rows}).collect()
    assert sorted(map(sorted, tasks)) == [["a0"], ["a1"], ["a2"]]
    assert readers.read_zipped_csv(spark, str(tmp_path / "a.zip"), ".none", "k string").collect() == []
