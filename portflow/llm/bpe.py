"""BPE encoding and decoding through a distinct-word table.

The tokenizer never looks across white space, so a text's ids are the ids of its words in order. Each block of
documents lists its distinct words once and holds its texts as positions in that list; the lists are dealt by word, so
that every distinct word meets in one task and is encoded once there; its ids return to the block and are joined by
position. What moves between tasks is word lists and ids. Texts stay where they are: blocks are a bucketed table, and
the join by block reads it without a shuffle.

Null text counts as empty, an empty text has no ids, repeated rows give repeated rows, other columns are ignored. Rows may
share a doc_id or have none. Without documents there are no rows.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.llm.shared import shared_dir, text_of

BLOCK_CHARS = 10_000_000
CACHE_WORDS = 1_000_000
_BLOCKS = "block string, bucket int, words binary, payload binary"

#: ASCII punctuation, and the letters of Latin-1, for which the tokenizer's rules are plain: one run of letters and
#: one run of punctuation after it are one token each before merging. Other words go through the whole tokenizer.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_PLAIN = re.compile(f"([a-zß-öø-ÿ]+)([{re.escape(PUNCTUATION)}]*)")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(2)  # a Python worker serves many tasks
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _pack(a: np.ndarray) -> bytes:
    """Integers as zstd over their byte planes, which suits codes given by falling frequency."""
    raw = np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(a).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    raw = pa.decompress(b[8:], decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view("<u4").ravel()


def _packs(*arrays: np.ndarray) -> bytes:
    parts = [_pack(a) for a in arrays]
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _unpacks(b: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(b):
        n = int.from_bytes(b[at : at + 8], "little")
        out.append(_unpack(b[at + 8 : at + 8 + n]))
        at += 8 + n
    return out


def _blocks(buckets: int, block_chars: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(name: str, doc: pa.Array, text: pa.Array) -> pa.RecordBatch:
        split = pc.ascii_split_whitespace(text)
        coded = split.flatten().dictionary_encode()
        flat = coded.indices.to_numpy()
        order = np.argsort(-np.bincount(flat, minlength=len(coded.dictionary)), kind="stable")  # common words get small codes
        code = np.empty(len(order), np.uint32)
        code[order] = np.arange(len(order), dtype=np.uint32)
        words = coded.dictionary.take(pa.array(order))
        # a word goes where it goes without its punctuation, in either case
        cores = pc.ascii_lower(pc.utf8_rtrim(words, characters=PUNCTUATION)).cast(pa.binary()).to_pylist()
        bucket = np.fromiter((crc32(w) % buckets for w in cores), np.uint32, len(cores))
        by = np.lexsort((pc.rank(words, tiebreaker="first").to_numpy(), bucket))
        ends = np.searchsorted(bucket[by], np.arange(buckets + 1))
        listed = words.take(pa.array(by)).to_pylist()
        lists = {b: "\n".join(listed[ends[b] : ends[b + 1]]).encode() for b in range(buckets) if ends[b + 1] > ends[b]}
        packed = [len(w).to_bytes(8, "little") + pa.compress(w, codec="zstd", asbytes=True) for w in lists.values()]
        ids = pc.fill_null(doc, 0).to_numpy().view(np.uint64)
        sizes = pc.list_value_length(split).to_numpy()
        payload = _packs(ids & np.uint64(0xFFFFFFFF), ids >> np.uint64(32), doc.is_valid().to_numpy(zero_copy_only=False), sizes, code[flat], by)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name] * (len(lists) + 1)),
                pa.array([-1, *lists], pa.int32()),
                pa.array([None, *packed], pa.binary()),
                pa.array([payload, *[None] * len(lists)], pa.binary()),
            ],
            ["block", "bucket", "words", "payload"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pa.set_cpu_count(1)
        part, k, held, chars = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            return rows(f"{part}-{k}", t.column(0).chunk(0), t.column(1).chunk(0))

        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy().astype(np.int64))
            at = 0
            while at < batch.num_rows:
                done = int(ends[at - 1]) if at else 0
                to = min(batch.num_rows, 1 + int(np.searchsorted(ends, done + block_chars - chars)))
                held.append(batch.slice(at, to - at))
                chars, at = chars + int(ends[to - 1]) - done, to
                if chars >= block_chars:
                    yield block()
                    held, chars, k = [], 0, k + 1
                    pa.default_memory_pool().release_unused()
        if held:
            yield block()

    return run


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet as a translation of Latin-1: printable bytes stand for themselves, the others for U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of words. What was met before is not encoded again, nor are a word's letters for each sign that may follow them."""

    def __init__(self, path: str):
        self.tokenizer, self.letters = _tokenizer(path), byte_letters()
        self.words: dict[str, list[int]] = {}
        self.parts: dict[str, list[int]] = {}

    def _whole(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _letters(self, part: str) -> list[int]:
        found = self.parts.get(part)
        if found is None:
            units = part.encode().decode("latin-1").translate(self.letters)
            found = self.parts[part] = [t.id for t in self.tokenizer.model.tokenize(units)]
        return found

    def __call__(self, words: list[str]) -> list[list[int]]:
        known = self.words
        if len(known) > CACHE_WORDS:
            known.clear()
            self.parts.clear()
        odd = []
        for w in words:
            if w not in known:
                m = _PLAIN.fullmatch(w.lower())
                if m is None:
                    odd.append(w)
                elif m[2]:
                    known[w] = self._letters(m[1]) + self._letters(m[2])
                else:
                    known[w] = self._letters(m[1])
        for at in range(0, len(odd), 20_000):
            some = odd[at : at + 20_000]
            known.update(zip(some, self._whole(some), strict=True))
        return [known[w] for w in words]


def _encode_words(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each row's words become their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for i in range(batch.num_rows):
                packed = batch.column("words")[i].as_py()
                words = pa.decompress(packed[8:], decompressed_size=int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True).decode().split("\n")
                ids = encoder(words)
                sizes = np.fromiter(map(len, ids), np.uint32, len(ids))
                out = _packs(sizes, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())))
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), batch.column("bucket").slice(i, 1), pa.array([out], pa.binary())], ["block", "bucket", "ids"])

    return run


def _gather(starts: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The runs values[starts[i] : starts[i] + sizes[i]], one after the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    if not len(ends) or not ends[-1]:
        return values[:0]
    return values[np.repeat((starts - (ends - sizes)).astype(np.int32), sizes) + np.arange(ends[-1], dtype=np.int32)]


def _assemble(blocks: pa.Table, encoded: pa.Table) -> pa.Table:
    """A block's ids, joined to its texts by position."""
    low, high, known, words, codes, order = _unpacks(blocks.column("payload")[0].as_py())
    doc = (low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))).view(np.int64)
    parts = [_unpacks(w) for _, w in sorted(zip(encoded.column("bucket").to_pylist(), encoded.column("ids").to_pylist(), strict=True))]
    by_bucket = np.concatenate([p[0] for p in parts] or [np.zeros(0)]).astype(np.int32)
    flat = np.concatenate([p[1] for p in parts] or [np.zeros(0)]).astype(np.int32)
    size, start = np.zeros(len(order), np.int32), np.zeros(len(order), np.int32)
    size[order], start[order] = by_bucket, np.cumsum(by_bucket) - by_bucket
    upto = np.concatenate([[0], np.cumsum(size[codes], dtype=np.int64)])
    offsets = np.concatenate([[0], upto[np.cumsum(words, dtype=np.int64)]]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(_gather(start[codes], size[codes], flat)))
    return pa.table({"doc_id": pa.array(doc, mask=known == 0), "ids": ids})


def encode(
    docs: DataFrame, path: str | None = None, buckets: int | None = None, then: Callable[[pa.Table], pa.Table] | None = None, schema: str = "doc_id long, ids array<int>",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(doc_id, ids): the ids of every whole text, as the tokenizers library gives them without special tokens added.

    A task holds a block of about `block_chars` bytes: larger ones share more words, smaller ones need less memory. `then` turns each block's (doc_id, ids) into rows of `schema` where they are made.
    """
    spark, path = docs.sparkSession, path or vocabulary_path()
    buckets = buckets or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"bpe_blocks_{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(_blocks(buckets, block_chars), _BLOCKS)
    rows.write.bucketBy(buckets, "block").option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    blocks = spark.table(name)
    spark.sql(f"drop table {name}")  # from the catalogue; its files stay, and the plan knows them and their buckets
    words = blocks.where("bucket >= 0").select("block", "bucket", "words").repartition(buckets, "bucket")
    encoded = words.mapInArrow(_encode_words(path), "block string, bucket int, ids binary")
    texts = blocks.where("bucket < 0").select("block", "payload")

    def assemble(texts: pa.Table, encoded: pa.Table) -> pa.Table:
        out = _assemble(texts, encoded)
        out = then(out) if then else out
        pa.default_memory_pool().release_unused()
        return out

    return texts.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(assemble, schema)


@lru_cache(2)
def pieces(path: str) -> pa.Array:
    """The id-to-piece table. Its size is the vocabulary's, whatever the input."""
    t = _tokenizer(path)
    return pa.array([t.id_to_token(i) or "" for i in range(t.get_vocab_size(with_added_tokens=True))])


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): every id joined to its piece, pieces set side by side with a blank, special ones kept.

    The table of pieces is bounded by the vocabulary, so each task holds it and joins by taking rows at the ids.
    Null ids give the empty text.
    """
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(path)
        for batch in batches:
            ids = batch.column("ids")
            ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
            for at in range(0, len(ids), 500):
                some = ids.slice(at, 500)
                sizes = pc.fill_null(pc.list_value_length(some), 0).to_numpy(zero_copy_only=False)
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                text = pc.binary_join(pa.ListArray.from_arrays(offsets, table.take(some.flatten())), " ")
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, 500), some, text], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document the number of ids, and the SHA-256 of the ids in decimal and of the text decoded from them."""
    both = decode(encode(docs, path), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
