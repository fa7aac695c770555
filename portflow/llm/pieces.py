"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is written with a mark in place of each blank and one more in front. Its characters are the first symbols; an agenda of
adjacent pairs that are pieces themselves, ordered by score and then by place, is worked off from the best pair on: the
pair becomes one symbol, and its pairs with its neighbours join the agenda. What is no piece in the end goes as bytes. As no
piece has a mark after another character, nor ASCII signs beside letters (a vocabulary is asked), words never merge with each
other, and a Python worker encodes each word it remembers once. What is new in an Arrow batch is held against the sentencepiece library, and
so are the batch's decoded texts; a difference fails the job.

Null text counts as empty, an empty text has no ids and decodes to the empty text, repeated rows give repeated rows, other
columns are ignored. Rows may share a doc_id or have none. Without documents there are no rows. A long text is encoded whole;
a long word is a long agenda, whose work grows as n log n.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.llm.shared import text_of

#: The sign that stands for a blank.
MARK = "▁"
#: Characters that are encoded at a time, words that a Python worker remembers, and the longest of them.
SLICE_CHARS, CACHE_WORDS, CACHE_LETTERS = 2_000_000, 800_000, 64
#: Words of more characters than this have a heap as their agenda; a rank that no pair has.
SHORT, NEVER = 32, 1 << 30
#: Words end before a mark, and between Latin letters and ASCII that is no letter.
_LETTERS, _SIGNS = "A-Za-zÀ-ÿ", r"\x00-@\[-`{-\x7f"
_OTHER = f"(?![^{MARK}{_LETTERS}{_SIGNS}])"
_WORDS = re.compile(f"{MARK}*(?:[{_LETTERS}]++{_OTHER}|[{_SIGNS}]++{_OTHER}|[^{MARK}]+)|{MARK}+")
_ACROSS = re.compile(f"[^{MARK}]{MARK}|[{_SIGNS}][{_LETTERS}]|[{_LETTERS}][{_SIGNS}]")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces, their order by score, and the bytes that stand in for what is no piece."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        model.ParseFromString(sp.serialized_model_proto())
        kind, rules = pb.ModelProto.SentencePiece, model.normalizer_spec
        pieces = [p.piece for p in model.pieces]
        plain = [i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL]
        merges = model.trainer_spec.model_type == pb.TrainerSpec.BPE and model.trainer_spec.byte_fallback
        as_is = rules.name == "identity" and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
        if not merges or not as_is or any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces) or any(_ACROSS.search(pieces[i]) or "\n" in pieces[i] for i in plain):
            raise ValueError("a vocabulary of merges with bytes to fall back on, texts taken as they are, and no piece across words or with a line feed is needed")
        self.ids = {pieces[i]: i for i in plain}
        scores = sorted({model.pieces[i].score for i in plain}, reverse=True)
        order = {s: k for k, s in enumerate(scores)}
        self.rank = {pieces[i]: order[model.pieces[i].score] for i in plain if len(pieces[i]) > 1}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        surfaces = [p.piece.replace(MARK, " ").encode() if p.type == kind.NORMAL else b"" for p in model.pieces]
        surfaces[sp.unk_id()] = model.trainer_spec.unk_surface.encode()
        for b, i in enumerate(self.byte_ids):
            surfaces[i] = bytes([b])
        self.surfaces = pa.array(surfaces, pa.binary())
        self.is_byte = np.isin(np.arange(len(pieces)), self.byte_ids)
        self.is_marked = np.array([p.startswith(MARK) for p in pieces])
        self.is_silent = np.array([p.type == kind.CONTROL for p in model.pieces])

    def merged(self, word: str) -> list[str]:
        """The symbols of a word when no pair on the agenda is left."""
        return self._merged_long(word) if len(word) > SHORT else self._merged_short(word)

    def _merged_short(self, word: str) -> list[str]:
        """The agenda as a list beside the symbols: its best entry, the first of equals, is found by looking through it."""
        rank, symbols = self.rank.get, list(word)
        agenda = [rank(word[i : i + 2], NEVER) for i in range(len(word) - 1)]
        while agenda and (best := min(agenda)) != NEVER:
            at = agenda.index(best)
            both = symbols[at] + symbols[at + 1]
            symbols[at] = both
            del symbols[at + 1], agenda[at]
            if at:
                agenda[at - 1] = rank(symbols[at - 1] + both, NEVER)
            if at < len(agenda):
                agenda[at] = rank(both + symbols[at + 1], NEVER)
        return symbols

    def _merged_long(self, word: str) -> list[str]:
        """The agenda as a heap; symbols know their neighbours, and entries that no longer hold are passed over."""
        rank, n, symbols = self.rank, len(word), list(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [r << 32 | i for i in range(n - 1) if (r := rank.get(word[i : i + 2])) is not None]
        heapify(agenda)
        while agenda:
            best = heappop(agenda)
            left = best & 0xFFFFFFFF
            right = after[left]
            if not symbols[left] or right >= n:
                continue
            both = symbols[left] + symbols[right]
            if rank.get(both) != best >> 32:  # one of the two has become another symbol meanwhile
                continue
            symbols[left], symbols[right] = both, ""
            follows = after[left] = after[right]
            if follows < n:
                before[follows] = left
                if (r := rank.get(both + symbols[follows])) is not None:
                    heappush(agenda, r << 32 | left)
            leads = before[left]
            if leads >= 0 and (r := rank.get(symbols[leads] + both)) is not None:
                heappush(agenda, r << 32 | leads)
        return [s for s in symbols if s]

    def encode_word(self, word: str) -> tuple[int, ...]:
        ids, as_bytes = self.ids, self.byte_ids
        out: list[int] = []
        for s in self.merged(word):
            if s in ids:
                out.append(ids[s])
            else:
                out += [as_bytes[b] for b in s.encode()]
        return tuple(out)


@lru_cache(2)  # a Python worker serves many tasks
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class _Known(dict):
    """Word -> ids; words that are not in it are encoded, and kept unless they are long. `new`: those that are not checked yet."""

    def __init__(self, v: Vocabulary):
        self.v, self.new = v, {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.new[word] = self.v.encode_word(word)
        if len(word) <= CACHE_LETTERS:
            self[word] = ids
        return ids

    def check(self) -> None:
        """Holds the new words against the library. It puts a mark before each text by itself, and a line feed merges with nothing."""
        asked, self.new = self.new, {}
        head = self.v.library.encode("\n")
        given = self.v.library.encode(["\n" + w.replace(MARK, " ") for w in asked], num_threads=1)
        if any([*head, *ours] != theirs for ours, theirs in zip(asked.values(), given, strict=True)):
            self.clear()  # or the words would count as checked when the task is tried again
            raise AssertionError("ids differ from the sentencepiece library's")


@lru_cache(2)
def _known(path: str) -> _Known:
    """What a worker has met, over its tasks. Each word that it keeps has been checked when it was new."""
    return _Known(vocabulary(path))


def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of rows of about `most` in size, one row at least."""
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < len(ends):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield at, to
        at = to


def _lists(rows: list[list[int]]) -> pa.ListArray:
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(sizes.sum()))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))


def _whole(a: pa.Array | pa.ChunkedArray) -> pa.Array:
    return a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a


def encode_texts(texts: list[str], known: _Known) -> list[list[int]]:
    """The ids of each text by the agenda; every word that was not met before is held against the library."""
    if len(known) > CACHE_WORDS:
        known.clear()
    take, split = known.__getitem__, _WORDS.findall
    rows = [list(chain.from_iterable(map(take, split(MARK + t.replace(" ", MARK))))) if t else [] for t in texts]
    known.check()
    return rows


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids): the ids of every whole text, without begin or end ids."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(path)
        for batch in batches:
            text = _whole(batch.column("text"))
            for at, to in _slices(pc.binary_length(text).to_numpy(), SLICE_CHARS):
                rows = encode_texts(text.slice(at, to - at).to_pylist(), known)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, to - at), _lists(rows)], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def _reads(some: bytes) -> bool:
    try:
        return len(some.decode()) == 1
    except UnicodeDecodeError:
        return False


def _repaired(ids: np.ndarray, v: Vocabulary) -> str:
    """Ids whose bytes do not all make characters: each byte of a run that is in none becomes a replacement sign."""
    surfaces, out, run = v.surfaces, [], b""

    def spelled(raw: bytes) -> str:
        text, at = "", 0
        while at < len(raw):
            size = next((n for n in (1, 2, 3, 4) if _reads(raw[at : at + n])), 0)
            text += raw[at : at + size].decode() if size else "\ufffd"
            at += size or 1
        return text

    for i in ids.tolist():
        if v.is_byte[i]:
            run += surfaces[i].as_py()
        else:
            out += [spelled(run), surfaces[i].as_py().decode()]
            run = b""
    return "".join([*out, spelled(run)])


def decode_rows(ids: pa.Array, v: Vocabulary) -> list[str]:
    """The text of each list of ids: every id joined to its piece, the pieces set side by side, the first blank taken off."""
    flat = ids.flatten().to_numpy()
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    raw = pc.binary_join(pa.ListArray.from_arrays(offsets, v.surfaces.take(pa.array(flat))), b"").to_pylist()
    loud = np.flatnonzero(~v.is_silent[flat])  # begin and end say nothing; the first piece beside them loses its mark
    first = np.searchsorted(loud, ends - sizes)
    out = []
    for i, text in enumerate(raw):
        marked = first[i] < len(loud) and loud[first[i]] < ends[i] and v.is_marked[flat[loud[first[i]]]]
        try:
            text = text.decode()
        except UnicodeDecodeError:
            text = _repaired(flat[ends[i] - sizes[i] : ends[i]], v)
        out.append(text[1:] if marked else text)
    return out


def decode(encoded: DataFrame, path: str | None = None, check: bool = True) -> DataFrame:
    """(doc_id, ids, decoded): the id-to-piece table is bounded by the vocabulary, so each task holds it. Null ids give the empty text."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            ids = _whole(batch.column("ids"))
            sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            for at, to in _slices(sizes, SLICE_CHARS // 4):
                some = ids.slice(at, to - at)
                text = decode_rows(some, v)
                if check and text != v.library.decode([x or [] for x in some.to_pylist()]):
                    raise AssertionError("texts differ from the sentencepiece library's")
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, to - at), some, pa.array(text, pa.string())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document the number of ids, and the SHA-256 of the ids in decimal and of the text decoded from them."""
    both = decode(encode(docs, path), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
