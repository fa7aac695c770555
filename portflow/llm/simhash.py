"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint's 64 bits are cut into 32 segments of two bits; its point has the bit count of each. One differing bit
moves one coordinate by one at most, so the Manhattan distance of two points is at most the Hamming distance of their
fingerprints. Points live in a grid over groups of coordinates: if `distance + r` groups share a Manhattan distance of
at most `distance`, some r of them share none of it, so two near points share the cell of those r groups. Points
that share a cell are held against each other by Manhattan distance first and by the differing bits last. The choice
of r follows the number of distinct fingerprints, and any r finds every link.

similar_groups() links texts whose shingle sets are similar (module shingles) instead: the links of fingerprints are its
first candidates, those that fingerprints can't reach its others, and all are verified on the sets.

A null or empty text has fingerprint zero, which links like any other. Repeated rows share their fingerprint, which
is compared once. A null doc_id is in a component but never names it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.llm import shingles
from portflow.llm.shared import components, salted_join, text_of, written
from portflow.llm.shingles import shingle_hashes

#: The contract of the query; similar_groups() takes those of shingles.
SHINGLE, SEED, BITS, DISTANCE = 4, 42, 64, 4
#: Bits that tell two random points apart, for each segment of two bits: -log2(1/16 + 1/4 + 1/16).
SEGMENT_BITS = 1.415
CELL_ROWS, STEPS = 64, 64
_LOW = 0x5555555555555555


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bits that are set in over half the hashes; zero if there are none."""
    n = len(hashes)
    if not n:
        return 0
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(n, 64)
    bits = np.add.reduceat(bits, np.arange(0, n, 255), axis=0).astype(np.int64).sum(axis=0)  # a byte counts to 255
    return int(np.packbits(bits * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): the 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((fingerprint_of(shingle_hashes(t, shingle, seed)) for t in batch.column("text").cast(pa.binary()).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, "doc_id long, fp long")


def unary_counts(fp: F.Column) -> F.Column:
    """The bit count of each segment in unary (00, 01, 11): differing bits add up to the Manhattan distance."""
    low, up = F.lit(_LOW), F.shiftrightunsigned(fp, 1)
    return fp.bitwiseOR(up).bitwiseAND(low).bitwiseOR(F.shiftleft(fp.bitwiseAND(up).bitwiseAND(low), 1))


def cells(distinct: int, distance: int = DISTANCE) -> list[int]:
    """Masks of the grids: for each choice of r groups the bits of their segments, as signed longs."""
    segments = BITS // 2
    for r in range(1, segments - distance + 1):
        groups = distance + r
        if distinct <= CELL_ROWS * 2 ** (SEGMENT_BITS * segments * r / groups) or groups == 12:
            break
    of = [sum(3 << 2 * s for s in range(segments) if s * groups // segments == g) for g in range(groups)]
    masks = [sum(c) for c in combinations(of, r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between node numbers as (node, root) with the same components: no more rows than nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _labels(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each fingerprint the root of its component under the edges (a, b)."""
    nodes, roots = forest(a, b)
    if not len(nodes):
        return fp
    at = np.minimum(np.searchsorted(nodes, fp), len(nodes) - 1)
    return np.where(nodes[at] == fp, roots[at], fp)


def _near(distance: int):
    """Over rows (grid, cell, ones, fp, point) in that order of cell and bit count: links within each cell, as forests.

    Rows of a cell are in order of their whole bit count, which near ones share up to `distance`, so that only a
    window of a cell is held. Comparisons are made for all cells of a batch at once, for neighbours 1, 2, ... STEPS apart. A
    cell that has more rows is by then mostly one component: only rows outside of its largest one are held against
    all others, as links within it change nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, label = None, np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(c).to_numpy().astype(np.int64) for c in ("grid", "cell", "ones", "fp", "point")]
            done = 0 if kept is None else len(kept[0])
            grid, cell, ones, fp, point = new if kept is None else (np.concatenate(x) for x in zip(kept, new, strict=True))
            n, found_a, found_b = len(fp), [], []

            def hold(x: np.ndarray, y: np.ndarray) -> None:
                bound = np.bitwise_count((point[x] ^ point[y]).view(np.uint64)) <= distance  # noqa: B023
                x, y = x[bound], y[bound]
                near = np.bitwise_count((fp[x] ^ fp[y]).view(np.uint64)) <= distance  # noqa: B023
                found_a.append(fp[x[near]])  # noqa: B023
                found_b.append(fp[y[near]])  # noqa: B023

            for step in range(1, STEPS + 1):
                i = np.arange(max(0, done - step), n - step)
                i = i[(cell[i] == cell[i + step]) & (grid[i] == grid[i + step]) & (ones[i + step] - ones[i] <= distance)]
                if not len(i):
                    break
                hold(i, i + step)
            change = np.flatnonzero((cell[1:] != cell[:-1]) | (grid[1:] != grid[:-1])) + 1
            starts, ends = np.concatenate([[0], change]), np.concatenate([change, [n]])
            labels = None
            for lo, hi in zip(starts, ends, strict=True):
                if hi - lo <= STEPS + 1:
                    continue
                if labels is None:
                    labels = _labels(fp, np.concatenate([*found_a, fp[:done]]), np.concatenate([*found_b, label]))
                names, count = np.unique(labels[lo:hi], return_counts=True)
                for x in np.flatnonzero(labels[lo:hi] != names[count.argmax()]) + lo:
                    near = lo + np.searchsorted(ones[lo:hi], [ones[x] - distance, ones[x] + distance + 1])
                    y = np.arange(near[0] if x >= done else max(near[0], done), near[1])  # kept ones have met each other
                    hold(np.full(len(y), x), y)
                if sum(map(len, found_a)) > 2_000_000:
                    a, b = forest(np.concatenate(found_a), np.concatenate(found_b))
                    found_a, found_b = [a], [b]
            a, b = forest(np.concatenate(found_a or [fp[:0]]), np.concatenate(found_b or [fp[:0]]))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["u", "v"])
            keep = (cell == cell[-1]) & (grid == grid[-1]) & (ones >= ones[-1] - distance)
            label = _labels(fp, np.concatenate([a, fp[:done]]), np.concatenate([b, label]))[keep]
            kept = [x[keep] for x in (grid, cell, ones, fp, point)]

    return run


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs of distinct fingerprints `distance` bits apart at most."""
    masks = cells(distinct.count(), distance)
    point = unary_counts(F.col("fp"))
    grids = F.array(*(F.struct(F.lit(k).alias("grid"), F.col("point").bitwiseAND(F.lit(m)).alias("cell")) for k, m in enumerate(masks)))
    rows = distinct.select("fp", point.alias("point"), F.bit_count("fp").alias("ones")).select("fp", "point", "ones", F.explode(grids).alias("g"))
    rows = rows.select("g.grid", "g.cell", "ones", "fp", "point").repartition("grid", "cell").sortWithinPartitions("grid", "cell", "ones")
    return rows.mapInArrow(_near(distance), "u long, v long")


def components_of(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) for every document."""
    fps = written(fingerprints(docs))
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    linked = components(links(distinct.select("fp"), distance)).withColumnRenamed("node", "fp").join(distinct, "fp")
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = salted_join(linked.select("fp", "root"), smallest, "root", "fp").select("fp", "component_id", F.lit(True).alias("linked"))
    named = distinct.join(named, "fp", "left").select("fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first")).alias("component_id"))
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    found = components_of(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def sketches(rows: DataFrame) -> DataFrame:
    """rows (row, text) as (row, digest, fp, bands) by shingles' words a shingle; equal sets have equal digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            digest, fp, bands = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64), []
            for i, text in enumerate(batch.column("text")):  # one text's hashes at a time
                hashes = shingle_hashes(text.as_buffer().to_pybytes())
                own = np.unique(hashes)
                digest[i], fp[i] = xxh64_intdigest(own.tobytes(), SEED), fingerprint_of(hashes)
                bands.append(shingles.bands_of(own))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(digest.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(bands, pa.list_(pa.int64()))], ["row", "digest", "fp", "bands"])

    return rows.select("row", text_of().alias("text")).mapInArrow(run, "row long, digest long, fp long, bands array<long>")


def similar_groups(rows: DataFrame, distance: int = DISTANCE, least: float = shingles.SIMILARITY) -> DataFrame:
    """rows (row, text; row unique and read again as it is) as (row, digest, root): rows of a group share their root.

    Of texts with one fingerprint each is held against one of them, of linked fingerprints one text of each; the rest of the
    candidates share a band of minima, and what these leave apart in large buckets is joined by prefix filter.
    """
    sketched = written(sketches(rows))
    sets = written(sketched.groupBy("digest").agg(F.min(F.struct("row", "fp", "bands")).alias("s")).select("digest", "s.*"))
    one = written(sets.groupBy("fp").agg(F.min(F.struct("digest", "row")).alias("one"), F.count("*").alias("n")))
    several, one = one.where("n > 1").drop("n"), one.drop("n")
    same = salted_join(sets.select("fp", F.struct("digest", "row").alias("m")), several, "fp", "m").where("m.digest <> one.digest").select("m", F.col("one").alias("o"))
    near = links(one.select("fp"), distance).where("u <> v").distinct()
    near = near.join(one.withColumnsRenamed({"fp": "u", "one": "m"}), "u").join(one.withColumnsRenamed({"fp": "v", "one": "o"}), "v").select("m", "o")
    roots = components(shingles.verified([same, near, shingles.candidates(sets)], rows, least))
    more = shingles.missed(sets, roots, rows, least)
    if more is not None:
        roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(more))
    return sketched.join(roots.withColumnRenamed("node", "digest"), "digest", "left").select("row", "digest", F.coalesce("root", "digest").alias("root"))
