"""Sets of word shingles for near-duplicates: what operator 6 takes where texts are to be similar, not fingerprints near.

A text is the set of its shingles of SHINGLE words (one shorter shingle, if it has fewer words; none, if it has no words).
Two texts are near if the Jaccard similarity of their sets is SIMILARITY at least. At that similarity two fingerprints are
about ten bits apart, out of reach of any grid, so that candidates also come from MinHash: texts that share a band of ROWS
minima, of BANDS. A pair at the least similarity shares a band with probability 1 - (1 - 0.8^5)^16 = 0.998, a nearer one
with more. Every candidate is verified on the sets themselves, so nothing less similar is ever linked.

Candidates come in two passes. First each set is held against the first one and the NEXT following ones of its bucket, in
order of the next two bands and in PARTS by digest, so that no task has a whole bucket, and the first ones of the parts
likewise against each other: all pairs of up to NEXT + 2 sets, and mostly whole groups of larger ones. Then the sets of
larger buckets that hold several components are joined by prefix filter (missed()), which finds every link between
components that the first pass left apart. So every pair that shares a band is linked, directly or by others; what is
lost is what shares none. Equal sets are one from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portflow.llm.shared import salted_join, text_of, written

SHINGLE, SIMILARITY, SEED = 5, 0.8, 42
BANDS, ROWS, NEXT, PARTS = 16, 5, 4, 64
#: Hashes of a batch of sets.
HELD = 1 << 20
#: Shingles before and after one that a pair shares which are looked at when it meets.
WINDOW = 16
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The hash of every shingle in order, repeats included."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    first, last = [0, *(ends[: n - 1] + 1).tolist()], ends[-n:].tolist()
    return np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in zip(first, last, strict=True)), np.uint64, n)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; empty sets are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def bands_of(hashes: np.ndarray) -> list[int]:
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(hashes), 512):
        np.minimum(least, (hashes[at : at + 512, None] * _FACTORS).min(axis=0), out=least)
    keys = np.zeros(BANDS, np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ column) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64).tolist()


def _neighbours(members: DataFrame, by: list[str]) -> DataFrame:
    """Pairs (a, b) of each member with the first and the NEXT following ones of its group."""
    group = Window.partitionBy(*by).orderBy("m")
    near = F.array(F.first("m").over(group), *(F.lead("m", k).over(group) for k in range(1, NEXT + 1)))
    pairs = members.select("m", near.alias("near")).select("m", F.explode("near").alias("o")).where("o is not null and o.digest <> m.digest")
    return pairs.select(F.struct("m.digest", "m.row").alias("m"), F.struct("o.digest", "o.row").alias("o"))


def candidates(sets: DataFrame) -> DataFrame:
    """sets (digest, row, bands), one row a set: pairs (m, o) of (digest, row) that share a band."""
    band = lambda k: F.col("bands")[(F.col("band") + k) % BANDS]
    members = sets.select("*", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
    members = members.select("band", band(0).alias("key"), F.struct(band(1).alias("b1"), band(2).alias("b2"), "digest", "row").alias("m"))
    members = members.withColumn("part", F.pmod(F.xxhash64("m.digest"), F.lit(PARTS)))
    nth = F.row_number().over(Window.partitionBy("band", "key", "part").orderBy("m"))
    heads = members.withColumn("nth", nth).where(F.col("nth") <= NEXT + 1)
    return _neighbours(members, ["band", "key", "part"]).unionAll(_neighbours(heads, ["band", "key"]))


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, root, text) as (digest, root, n, hashes)."""
    for batch in batches:
        own, at = [], 0
        for i, text in enumerate(batch.column("text")):
            own.append(np.unique(shingle_hashes(text.as_buffer().to_pybytes())).view(np.int64))
            if sum(map(len, own)) >= HELD or i == batch.num_rows - 1:
                part = batch.select(["digest", "root"]).slice(at, len(own))
                sizes = pa.array([len(x) for x in own], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, sizes, pa.array(own, pa.list_(pa.int64()))], ["digest", "root", "n", "hashes"])
                own, at = [], i + 1


def missed(sets: DataFrame, roots: DataFrame, rows: DataFrame, least: float = SIMILARITY) -> DataFrame | None:
    """Edges (u, v) of digests: all similar pairs with different roots in buckets of over NEXT + 2 sets; None if there are no such buckets.

    roots (node, root) are the components of the sets so far. In one order of all shingles, rare ones first, two similar sets
    share one of their first few: of the larger set n - ceil(least * n) + 1, of the smaller one n - ceil(2 * least / (1 + least) * n) + 1.
    Shingles of one component only come first and are not joined, so that sets of one component never meet, however many they are.
    A pair meets at the first shingle that it shares: where it also shares one of the WINDOW shingles before, it has met there. It is
    dropped where those that follow can't be enough: of the next WINDOW those shared, beyond them what the one with more there has
    left. The others are verified on the shingles of several components, which are all that they can share. No text is shipped.
    """
    named = written(sets.select("digest", "row", "bands").join(roots.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest")))
    members = named.select("digest", "row", "root", F.posexplode("bands").alias("band", "key")).withColumn("bucket", F.xxhash64("band", "key")).drop("band", "key")
    mixed = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = mixed.where((F.col("n") > NEXT + 2) & (F.col("low") < F.col("high"))).select("bucket")
    asked = written(salted_join(members, mixed, "bucket", "digest").select("digest", "row", "root").distinct())
    if asked.isEmpty():
        return None
    held = rows.select("row", text_of().alias("text")).join(asked, "row").select("digest", "root", "text")
    held = written(held.mapInArrow(_sets_of, "digest long, root long, n long, hashes array<long>"))
    each = held.select("digest", "root", F.explode("hashes").alias("hash"))
    common = each.groupBy("hash").agg(F.count("*").alias("f"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("hash", "f")
    shared = salted_join(each.select("digest", "hash"), common, "hash", "digest").groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("f", "hash"))).alias("shared"))
    shared = shared.select("digest", F.transform("shared", lambda x: x.hash).alias("shared"))
    tokens = written(held.drop("hashes").join(shared, "digest"))  # a list has a text's shingles at most

    def first(share: float) -> DataFrame:
        exclusive = F.col("n") - F.size("shared")
        length = F.greatest(F.lit(0), F.col("n") - F.ceil(F.col("n") * F.lit(share) - F.lit(1e-9)) + 1 - exclusive).cast("int")
        at = lambda x, i: F.struct(
            i.alias("at"), x.alias("hash"), F.slice("shared", F.greatest(F.lit(1), i + 1 - WINDOW), F.least(i, F.lit(WINDOW))).alias("before"), F.slice("shared", i + 2, F.lit(WINDOW)).alias("after")
        )
        each = tokens.select("digest", "root", "n", F.size("shared").alias("size"), F.transform(F.slice("shared", F.lit(1), length), at).alias("t"))
        each = each.select("digest", "root", "n", "size", F.explode("t").alias("t"))
        return each.select("t.hash", F.struct("n", "digest", "root", (F.col("size") - 1 - F.col("t.at")).alias("rest"), "t.before", "t.after").alias("m"))

    need = F.ceil((F.col("m.n") + F.col("o.n")) * F.lit(least / (1 + least)) - F.lit(1e-9))
    beyond = F.greatest(F.col("m.rest") - F.size("m.after"), F.col("o.rest") - F.size("o.after"))
    rest = F.least("m.rest", "o.rest", F.size(F.array_intersect("m.after", "o.after")) + beyond)
    pairs = salted_join(first(least), first(2 * least / (1 + least)).withColumnRenamed("m", "o"), "hash", "m")
    pairs = pairs.where((F.col("m.root") != F.col("o.root")) & (F.struct("o.n", "o.digest") < F.struct("m.n", "m.digest")) & (F.col("o.n") >= F.col("m.n") * F.lit(least) - F.lit(1e-9)))
    pairs = pairs.where((F.least("m.rest", "o.rest") + 1 >= need) & ~F.arrays_overlap("m.before", "o.before") & (rest + 1 >= need))
    pairs = written(pairs.groupBy(F.col("m.digest").alias("u"), F.col("o.digest").alias("v")).agg(F.first(need).alias("need")))
    own = tokens.select("digest", "shared")
    both = pairs.join(own.toDF("u", "u_shared"), "u").join(own.toDF("v", "v_shared"), "v")
    return both.where(F.size(F.array_intersect("u_shared", "v_shared")) >= F.col("need")).select("u", "v")


def verified(pairs: list[DataFrame], rows: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Edges (u, v) of digests: the pairs (m, o) of (digest, row) whose texts, in rows (row, text), are similar. rows is read more than once."""
    pairs = reduce(DataFrame.unionAll, pairs).select(F.least("m", "o").alias("a"), F.greatest("m", "o").alias("b")).distinct()
    pairs = written(pairs.select(F.col("a.digest").alias("u"), F.col("a.row").alias("u_row"), F.col("b.digest").alias("v"), F.col("b.row").alias("v_row")))
    asked = written(pairs.select(F.col("u_row").alias("row")).unionAll(pairs.select(F.col("v_row").alias("row"))).distinct())
    texts = written(rows.select("row", text_of().alias("text")).join(asked, "row", "left_semi"))
    both = pairs.join(texts.withColumnsRenamed({"row": "u_row", "text": "u_text"}), "u_row").join(texts.withColumnsRenamed({"row": "v_row", "text": "v_text"}), "v_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(batch.column("u_text"), batch.column("v_text"), strict=True)
            near = pa.array([similarity(*(np.unique(shingle_hashes(t.as_buffer().to_pybytes())) for t in pair)) >= least for pair in texts], pa.bool_())
            yield batch.select(["u", "v"]).filter(near)

    return both.select("u", "v", "u_text", "v_text").mapInArrow(run, "u long, v long")
