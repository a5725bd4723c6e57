"""Token ids as Arrow files of equal-length sequences with masks.

Every shard is a pair of Arrow IPC files: ``tokens-*`` holds record batches of
``batch_rows`` sequences, each sequence a fixed-size list of ids next to a
fixed-size list of mask bits (0 for the padding behind a shard's last token);
``index-*`` says for every document where its ids begin in the shard and how
many there are. The files are not compressed, so a memory map gives any
sequence without a copy: sequence ``k`` is row ``k % batch_rows`` of batch
``k // batch_rows``.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from millrace.llm.shared import hand_back, light_batches, once_per_worker, only, written
from millrace.session import scratch_path

SEQUENCE = 2048
BATCH_ROWS = 256
# a full stop or comma between an ASCII letter and white space is a pre-token of its own
LONE_MARK = re.compile(rb"(?<=[A-Za-z])([.,])(?=\s|$)")
# characters that compose with a letter before them begin at U+0300, with a byte of 0xCC in UTF-8
MAY_COMPOSE = re.compile(rb"[A-Z][\xcc-\xff]")
# normalizers that leave a word of ASCII small letters as it is, and a split that hands it over whole
WORDS_STAY = {"NFC", "Lowercase", "Replace"}
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CACHED_PIECES = 400_000
MANIFEST = "shard int, tokens_file string, index_file string, n_docs long, n_ids long"


def _gather(pool: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The slices ``pool[first : first + count]`` one after the other."""
    upto = np.cumsum(count)
    return pool[np.repeat(first - upto + count, count) + np.arange(upto[-1] if len(upto) else 0)]


def _plain_spec(spec: dict) -> dict | None:
    """The same model behind a split at white space alone, which gives words of ASCII small letters the same ids.

    None unless the tokenizer's steps before its model are known to leave such words whole.
    """
    normalizer, split = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
    steps = normalizer.get("normalizers", [normalizer] if normalizer else [])
    stays = all(s["type"] in WORDS_STAY and s.get("pattern", {"Regex": r"\s+"}) == {"Regex": r"\s+"} for s in steps)
    match split.get("pretokenizers"):
        case [{"type": "Split", "pattern": {"Regex": pattern}, "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}] if stays and pattern == WORD_SPLIT:
            return spec | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}
    return None


class PieceEncoder:
    """Token ids of texts by way of the distinct pieces between ASCII white space.

    Exact for tokenizers whose pre-tokens never span white space: each distinct
    piece is tokenized once and its ids are looked up from then on. The table of
    pieces is emptied when it exceeds ``CACHED_PIECES``.
    """

    def __init__(self, path: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        spec = json.loads(self.tokenizer.to_str())
        self.specials = [t["content"].encode() for t in spec["added_tokens"]]
        self.lowers = '"Lowercase"' in json.dumps(spec["normalizer"])
        self.size = self.tokenizer.get_vocab_size()
        plain = _plain_spec(spec)
        self.plain = Tokenizer.from_str(json.dumps(plain)) if plain else None
        suffix = spec["model"].get("end_of_word_suffix")
        self.is_end = np.zeros(self.size, bool)
        if suffix:
            self.is_end[[i for i in range(self.size) if (self.tokenizer.id_to_token(i) or "").endswith(suffix)]] = True
        self.reset()

    def reset(self) -> None:
        encoder = self

        class Places(dict):
            """Piece to its place in the table of ids; new pieces queue up."""

            def __missing__(self, piece: bytes) -> int:
                place = self[piece] = len(self) + 1  # place 0 is the end mark
                encoder.queue.append(piece)
                return place

        self.places, self.queue = Places(), []
        self.ids = np.array([self.end_id], np.uint32)
        self.first, self.count = np.zeros(1, np.int64), np.ones(1, np.int64)

    def _tokenize(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and for each piece where its ids begin and how many they are.

        Pieces of letters are one pre-token each, so many go in one call and are
        told apart by the ids that end a word; if those are not as many as the
        pieces, each piece goes alone.
        """

        def ids(tokenizer, texts: list[str]) -> list[list[int]]:
            return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        def flat(lists: list[list[int]]) -> np.ndarray:
            return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))

        is_word = np.fromiter(map(str.isalpha, pieces), bool, len(pieces)) & self.is_end.any()
        is_plain = np.fromiter((p.isascii() and p.islower() for p in pieces), bool, len(pieces)) & (self.plain is not None)
        alone, pools, size = np.ones(len(pieces), bool), [], 0
        first, count = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        for tokenizer, some in ((self.plain, is_word & is_plain), (self.tokenizer, is_word & ~is_plain)):
            words = [pieces[k] for k in np.flatnonzero(some)]
            pool = flat(ids(tokenizer, [" ".join(words[k : k + 200]) for k in range(0, len(words), 200)])) if words else np.zeros(0, np.int64)
            ends = np.flatnonzero(self.is_end[pool]) + 1
            if len(ends) != len(words) or len(ends) and ends[-1] != len(pool):
                continue
            alone &= ~some
            count[some] = np.diff(ends, prepend=0)
            first[some] = size + ends - count[some]
            pools, size = [*pools, pool], size + len(pool)
        others = ids(self.tokenizer, [pieces[k] for k in np.flatnonzero(alone)])
        count[alone] = list(map(len, others))
        first[alone] = size + np.cumsum(count[alone]) - count[alone]
        return np.concatenate([*pools, flat(others)]), first, count

    def _drain(self) -> None:
        """Tokenize the queued pieces and file their ids."""
        pool, first, count = self._tokenize([p.decode() for p in self.queue])
        self.first = np.concatenate([self.first, len(self.ids) + first])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, pool.astype(np.uint32)])
        self.queue = []

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each followed by the end id, and their counts."""
        if len(self.places) > CACHED_PIECES:
            self.reset()
        look, rows = self.places.__getitem__, []
        for text in texts:
            raw = (text or "").encode()
            lowered = raw.lower()  # ASCII letters only
            lowers = self.lowers and not any(s in lowered for s in self.specials)
            # a letter that may compose with what follows must meet it as it is
            whole = raw.isascii() or not MAY_COMPOSE.search(raw)
            pieces = LONE_MARK.sub(rb" \1", lowered if lowers and whole else raw).split()
            if lowers and not whole:
                pieces = [p.lower() if p.isascii() else p for p in pieces]
            row = np.zeros(len(pieces) + 1, np.int32)
            row[:-1] = np.fromiter(map(look, pieces), np.int32, len(pieces))
            rows.append(row)
        if self.queue:
            self._drain()
        place = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        count = self.count[place]
        ends = np.cumsum([len(r) for r in rows], dtype=np.int64) - 1
        return _gather(self.ids, self.first[place], count), np.diff(np.cumsum(count)[ends], prepend=0)


def _create(uri: str, schema: pa.Schema):
    """An IPC writer on a new file of its own name, and what puts it in place."""
    store, path = pafs.FileSystem.from_uri(uri)
    own = f"{path}.{uuid.uuid4().hex}"
    sink = store.open_output_stream(own)
    writer = pa.ipc.new_file(sink, schema)

    def done() -> None:
        writer.close()
        sink.close()
        store.move(own, path)

    return writer, done


def _open(uri: str):
    store, path = pafs.FileSystem.from_uri(uri)
    local = isinstance(store, pafs.LocalFileSystem)
    return pa.ipc.open_file(pa.memory_map(path) if local else store.open_input_file(path))


class _Sequences:
    """Cuts a stream of ids into sequences and writes them in full batches."""

    def __init__(self, uri: str, length: int, rows: int, dtype):
        self.length, self.block = length, length * rows
        item = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(item, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.writer, self.done = _create(uri, self.schema)
        self.waiting, self.n, self.dtype = [], 0, dtype

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.dtype))
        self.n += len(ids)
        if sum(map(len, self.waiting)) >= self.block:
            flat = np.concatenate(self.waiting)
            full = len(flat) // self.block * self.block
            for at in range(0, full, self.block):
                self._write(flat[at : at + self.block], self.block)
            self.waiting = [flat[full:]]

    def _write(self, ids: np.ndarray, n: int) -> None:
        values = [pa.array(ids), pa.array(np.arange(len(ids)) < n)]
        lists = [pa.FixedSizeListArray.from_arrays(v, type=f.type) for v, f in zip(values, self.schema)]
        self.writer.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> None:
        rest = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.dtype)
        if len(rest):
            padding = np.zeros(-len(rest) % self.length, self.dtype)
            self._write(np.concatenate([rest, padding]), len(rest))
        self.done()


INDEX = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64())])


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 1,
    length: int = SEQUENCE,
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """Write the ids of all documents in ascending id order; return the manifest.

    ``docs`` is dealt out by ranges of ``doc_id``; every range becomes one shard,
    so shard order is document order. Null texts are empty, an empty text is the
    end id alone, null ids come first, rows with equal ids stand side by side in
    the order of a hash of their texts and the texts, and an empty table gives no
    shard with rows. Rows of one id, or without any, may fill several shards. A
    text of any length is encoded whole and spread over as many sequences as it
    takes. Ids take two bytes where the vocabulary allows, else four. A repeated
    task replaces its files by equal ones. ``folder`` must be reachable from all
    executors.
    """
    spark = docs.sparkSession
    light_batches(spark)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(hadoop)
    uri = store.makeQualified(hadoop).toString().replace("file:/", "file:///").replace("file://///", "file:///")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once_per_worker(("pieces", tokenizer, end_id), lambda: PieceEncoder(tokenizer, end_id))
        dtype = np.uint16 if max(encoder.size, end_id + 1) <= 1 << 16 else np.uint32
        number = TaskContext.get().partitionId()
        files = [f"{uri}/{kind}-{number:06d}.arrow" for kind in ("tokens", "index")]
        sequences, n_docs = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if sequences is None:
                sequences = _Sequences(files[0], length, batch_rows, dtype)
                index, done = _create(files[1], INDEX)
            for at in range(0, batch.num_rows, 250):
                some = batch.slice(at, 250)
                ids, counts = encoder.encode(some.column(1).to_pylist())
                first = sequences.n + np.cumsum(counts) - counts
                index.write_batch(pa.record_batch([some.column(0), pa.array(first), pa.array(counts)], schema=INDEX))
                sequences.add(ids)
                n_docs += some.num_rows
        if sequences is not None:
            sequences.close()
            done()
            encoder.reset()
            yield pa.RecordBatch.from_pylist([{"shard": number, "tokens_file": files[0], "index_file": files[1], "n_docs": n_docs, "n_ids": sequences.n}], schema=pa.schema([("shard", pa.int32()), ("tokens_file", pa.string()), ("index_file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))
        hand_back()

    rows = only(docs, doc_id=doc_id, text=text).withColumns({"doc_id": F.col("doc_id").cast("long"), "_h": F.xxhash64("text"), "_n": F.monotonically_increasing_id()})
    # the number only deals equal rows to several ranges; they are the same in any order
    ordered = rows.repartitionByRange("doc_id", "_h", "_n").sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text")
    return written(ordered.mapInArrow(shard, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, over all shards. The
    running total over the manifest has one row for each shard.
    """
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    shards = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    tasks = max(1, manifest.count())

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens, index = _open(row["tokens_file"]), _open(row["index_file"])
                length = tokens.schema.field("ids").type.list_size
                per_batch = len(tokens.get_batch(0)) * length
                held, values = -1, None
                for i in range(index.num_record_batches):
                    docs = index.get_batch(i)
                    crcs = []
                    for first, n in zip(docs.column(1).to_pylist(), docs.column(2).to_pylist()):
                        crc, at = 0, first
                        while at < first + n:
                            if at // per_batch != held:
                                held = at // per_batch
                                values = tokens.get_batch(held).column(0).flatten().to_numpy()
                            part = values[at % per_batch : at % per_batch + first + n - at]
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                            at += len(part)
                        crcs.append(crc)
                    start = np.asarray(docs.column(1)) + row["base"]
                    yield pa.record_batch([docs.column(0), pa.array(start), docs.column(2), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.repartition(tasks).mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, **options) -> DataFrame:
    """Write the files and read them back; one row for each row of ``docs``."""
    spark: SparkSession = docs.sparkSession
    return read_token_files(write_token_files(docs, folder or scratch_path(spark, "tokens"), tokenizer, **options))
