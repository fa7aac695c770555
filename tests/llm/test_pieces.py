"""The agenda against the sentencepiece library, texts and ids of all kinds."""

import hashlib
import random

import pytest

from portflow.llm import pieces, queries
from tests.conftest import SF
from tests.llm.test_operators import EDGES, docs

ALPHABET = [*"  ab0SZ,.!'-", "th", "ing", "ou", "é", "é", "\n", "\t", "\x00", "①", "😀", "▁", "<0x41>", "<s>", "的", "ﬁ", "　", "‍", "»,", "  "]


@pytest.fixture(scope="module")
def library():
    return pieces.vocabulary(pieces.model_path())


def random_texts(rng, n):
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 30))) for _ in range(n)]


def test_ids_and_texts(library):
    rng, known = random.Random(1), pieces._Known(library)
    for _ in range(200):
        texts = random_texts(rng, 20)
        ids = pieces.encode_texts(texts, known)
        assert ids == library.library.encode(texts)
        assert pieces.decode_rows(pieces._lists(ids), library) == library.library.decode(ids)


def test_any_ids_decode(library):
    """Bytes that make no character, control ids, unknown ones."""
    rng = random.Random(2)
    rows = [[rng.choice([rng.randrange(300), rng.randrange(32_000)]) for _ in range(rng.randint(0, 8))] for _ in range(5000)]
    assert pieces.decode_rows(pieces._lists(rows), library) == library.library.decode(rows)


def test_both_agendas_agree(library):
    rng = random.Random(3)
    for word in ["▁" * n for n in (1, 2, 7, 33, 100)] + ["▁" + "".join(rng.choices("aeinrst▁", k=rng.randint(1, 60))) for _ in range(2000)]:
        assert library._merged_short(word) == library._merged_long(word)


def test_a_long_word_is_no_trouble(library):
    word = "ab" * 100_000
    assert pieces.encode_texts([word], pieces._Known(library)) == [library.library.encode(word)]


def test_a_difference_is_told(library, monkeypatch):
    monkeypatch.setattr(library, "encode_word", lambda w: (0,))
    with pytest.raises(AssertionError):
        pieces.encode_texts(["a text"], pieces._Known(library))


def test_query(spark, library):
    """Every document of the query's table, by the library alone."""
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_sentencepiece(spark, SF).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.library.encode(r.text or "")
        assert got[r.doc_id] == (len(ids), sha(",".join(map(str, ids))), sha(library.library.decode(ids)))


def test_edges(spark, library):
    got = pieces.decode(pieces.encode(docs(spark, EDGES))).collect()
    want = sorted((str(d), library.library.encode(t or ""), library.library.decode(library.library.encode(t or ""))) for d, t in EDGES)
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in got) == want
    assert pieces.digests(docs(spark, [])).count() == 0
    assert [r.decoded for r in pieces.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).collect()] == [""]
