"""The trie of conversation prefixes against one built turn by turn."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from portflow.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string, conv long, d int, t string, part int, root string, key string"


def table(spark, rows, parts=5):
    return spark.createDataFrame([(*r, 1, 2, "t", 3, "r", "k") for r in rows], TURNS).repartition(parts)


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows):
    """Rows (conv_id, turn, role, text) -> the set of nodes."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append(((turn is not None, turn or 0), digest(role or "", text or ""), len((text or "").split())))
    own = {c: [(t, w) for _, t, w in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    nodes = {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes.setdefault(tuple(built[c][:d]), []).append(c)
    kids, leaves, saved = ({p: 0 for p in nodes} for _ in range(3))
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(members) - 1) * p[-1][1] if p else 0
    ends = {p: ",".join(str(c) for c in m if len(built[c]) == len(p)) for p, m in nodes.items()}
    return sorted(
        (m[0], len(p), nodes[p[:-1]][0] if p else -1, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends[p].encode()).hexdigest()) for p, m in nodes.items()
    )


def ours(df):
    return sorted(tuple(r) for r in df.withColumn("parent_conv_id", F.coalesce("parent_conv_id", F.lit(-1))).collect())


def corpus(rng, convs, texts, longest):
    rows = []
    for c in rng.sample(range(3 * convs), convs):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn if rng.random() < 0.95 else None, rng.choice(["user", None]), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    rows = corpus(rng, 40, ["a b", "a b c", "", None], 5)
    assert ours(prefix_trie.prefix_trie(table(spark, rows))) == brute(rows)


@pytest.mark.parametrize("chunk", [4, 5, 128])
def test_long_conversations_in_runs(spark, chunk):
    """Copies of long conversations, which end and part within a run, at its end, and after it; runs that one alone has."""
    rng = random.Random(chunk)
    stems = [[("user", rng.choice("xyz")) for _ in range(30)] for _ in range(2)]
    rows = []
    for c in range(26):
        stem, at = stems[c % 2], rng.choice([3, 4, 5, 8, 10, 12, 16, 20, 30])
        for turn, (role, text) in enumerate(stem[:at] + [("user", rng.choice("pq"))] * rng.choice([0, 0, 1, 3, 9])):
            rows.append((c, turn, role, text))
    assert ours(prefix_trie.prefix_trie(table(spark, rows), chunk)) == brute(rows)


def test_copies_over_many_partitions(spark):
    """One conversation in a hundred copies, one turn that all begin with: their nodes reach over all partitions."""
    rows = [(c, t, "user", f"same {t}") for c in range(0, 2000, 20) for t in range(3)] + [(20 * c + 2000, t, "user", f"same {t}" if t == 0 else f"own {c}") for c in range(60) for t in range(2)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert ours(prefix_trie.prefix_trie(table(spark, rows))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_conversation_has_most_turns(spark):
    """Its turns are ranked over several partitions."""
    rows = [(7, t, "user", f"t{t % 50}") for t in range(900)] + [(7, 3, "user", "again")] * 20 + [(8, 1, "user", "x")]
    turns, sizes = prefix_trie.placed_turns(table(spark, rows))
    assert {r.conv: r["size"] for r in sizes.collect()} == {7: 920, 8: 1}
    assert sorted(r.d for r in turns.where("conv = 7").collect()) == list(range(1, 921))
    assert ours(prefix_trie.prefix_trie(table(spark, rows))) == brute(rows)


def test_edges(spark):
    rows = [(None, 1, "user", "lost"), (21, 1, None, None), (22, None, "user", ""), (22, None, "user", ""), (-1, 1, "user", "word " * 30_000), (40, 1, "a", "b"), (41, 1, "ab", "")]
    assert ours(prefix_trie.prefix_trie(table(spark, rows))) == brute(rows)
    assert prefix_trie.prefix_trie(table(spark, [])).count() == 0
    assert ours(prefix_trie.prefix_trie(table(spark, [(None, 1, "user", "lost")]))) == []
    with pytest.raises(ValueError):
        prefix_trie.prefix_trie(table(spark, rows), 3)
