import random

import public_tokenizers
import pyarrow as pa
import pytest

from helpers import awkward_docs, by_id, frame, token_rows, tokenizer
from millrace.llm import token_files
from millrace.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_query(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert by_id(QUERIES["op8_token_files"](spark, folder).collect()) == by_id(token_rows(docs, PATH))


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_encoder_equals_the_tokenizer(name):
    encoder = token_files.PieceEncoder(public_tokenizers.path(name), 1)
    texts = [t for _, t, *_ in awkward_docs()] + ["a\x1cb\x85c d", "'s x's 's's don't 're", "ΑΣ Σ İI ſK", "a...b,, c,.d e. f, .,", "<|startoftext|>x <|STARTOFTEXT|>"]
    for some in (texts, texts[::-1]):
        ids, counts = encoder.encode(some)
        want = [tokenizer(PATH).encode(t or "", add_special_tokens=False).ids + [1] for t in some]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_encoder_equals_the_tokenizer_on_any_characters():
    """Seeded strings of letters, marks that compose with them, marks, blanks and rare characters."""
    rng = random.Random(8)
    marks = [chr(c) for c in range(0x300, 0x370)]
    letters = [chr(c) for c in (*range(65, 91), *range(97, 123))]
    other = list(" \t\n  .,;:'\"!?-_0123456789<|>ßİıſKÅÀéñøŁǅΑΣςσЖжאبकกあ漢한\u1100\u1161\xa0\x85\x1c\u200b\ufeff\U0001f600\U00010400\ufffd")
    encoder = token_files.PieceEncoder(PATH, 1)
    for n in range(60):
        texts = ["".join(rng.choice(rng.choice((letters, letters, marks, other, other))) for _ in range(rng.randint(0, 14))) for _ in range(500)]
        ids, counts = encoder.encode(texts)
        want = [e.ids + [1] for e in tokenizer(PATH).encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def check_files(got, docs):
    """Rows of an id, which may have several texts, stand side by side in any order; ids ascend and starts add up."""
    plain = lambda rows: sorted((str(r[0]), r[2], r[3]) for r in rows)
    assert plain(got) == plain(token_rows(docs, PATH))
    got = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in docs), key=lambda d: (d is not None, d or 0))
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]


def test_awkward_rows(spark):
    rows = awkward_docs() + [(None, "x y", "en", "s", 3)] * 40 + [(7, f"text {k}", "en", "s", 3) for k in range(60)] + [(12, "Y\u030a T\u0308 end", "en", "s", 3)]
    docs = frame(spark, rows).withColumnRenamed("lang", "start").withColumnRenamed("source", "shard")
    first, again = (token_files.token_files(docs, PATH, length=16, batch_rows=4).collect() for _ in range(2))
    check_files(first, [r[:2] for r in rows])
    assert sorted(first, key=lambda r: r.start) == sorted(again, key=lambda r: r.start)


def test_empty_table(spark):
    assert token_files.token_files(frame(spark, []), PATH).collect() == []


def test_files_hold_sequences_and_masks(spark, tmp_path):
    manifest = token_files.write_token_files(frame(spark, [(d, "some words here " * d, "x", "s", 1) for d in range(1, 30)]), str(tmp_path / "out"), PATH, length=16, batch_rows=4).collect()
    total = 0
    for shard in manifest:
        with pa.memory_map(shard.tokens_file.removeprefix("file://")) as source:
            file = pa.ipc.open_file(source)
            assert file.schema.field("ids").type == pa.list_(pa.uint16(), 16) and file.schema.field("mask").type == pa.list_(pa.bool_(), 16)
            masks = [m for k in range(file.num_record_batches) for m in file.get_batch(k).column(1).to_pylist()]
            assert all(len(file.get_batch(k)) == 4 for k in range(file.num_record_batches - 1))
            flat = [x for m in masks for x in m]
            assert sum(flat) == shard.n_ids and flat[: shard.n_ids] == [True] * shard.n_ids
            total += shard.n_ids
    assert total == sum(3 * d + 1 for d in range(1, 30)) and sum(s.n_docs for s in manifest) == 29


def test_letters_that_cannot_compose_are_lowered_before_pieces_are_told_apart():
    encoder = token_files.PieceEncoder(PATH, 1)
    texts = ["TÉst tÉst Été", "Y̊ ẙ T̸É", "AĀ I˿B Ž"]
    ids, counts = encoder.encode(texts[:1])
    assert len(encoder.places) == 2
    ids, counts = encoder.encode(texts)
    want = [tokenizer(PATH).encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_plain_words_take_the_short_way_of_known_tokenizers_only():
    import json

    encoder = token_files.PieceEncoder(PATH, 1)
    words = ["the", "oftionnten", "Été", "été", "x1", "word's", "Shout", "zqxj"]
    want = [tokenizer(PATH).encode(w, add_special_tokens=False).ids for w in words]
    assert encoder.plain is not None
    assert [encoder.plain.encode(w, add_special_tokens=False).ids for w in words if w.isascii() and w.isalpha() and w.islower()] == [want[0], want[1], want[7]]
    pool, first, count = encoder._tokenize(words)
    assert [pool[a : a + n].tolist() for a, n in zip(first, count)] == want
    spec = json.loads(encoder.tokenizer.to_str())
    for change in ({"normalizer": {"type": "Prepend", "prepend": "_"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": None}):
        assert token_files._plain_spec(spec | change) is None
