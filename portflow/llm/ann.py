"""Approximate nearest neighbours by inner product, on robust-pruned directed graphs.

Vectors are dealt to shards by hash. In each shard a graph grows: points are inserted in batches, a greedy search over
the graph so far proposes neighbours, and relaxed distance pruning keeps diverse edges; edges back are added and pruned
alike. A query walks every shard's graph with a beam, and the shards' answers are merged.

Edges are chosen between the vectors' directions, and the search walks them by inner product with the vectors as they
are, so that neither long nor short vectors are out of reach (recall by spread of lengths: README). Equal vectors are
one point of the graph; the k + 1 smallest ids of each are kept with it, which is all that an answer of k can hold.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows with a null id. Vectors
of different numbers of components have no inner product: each number has shards of its own, and a query meets those
of its number. Rows that repeat an id and a vector count once. An id with several vectors asks with the least of
them (as arrays compare) and is found by its nearest one. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portflow.llm.shared import written

SHARD_POINTS, QUERY_BLOCK = 4096, 2048
SEEN_BYTES = 16_000_000
DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA, WIDTH, INSERT = 32, 64, 128, 1.2, 4, 512


def beam_search(graph: np.ndarray, points: np.ndarray, queries: np.ndarray, entry: int, beam: int, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """For all queries in step: the `beam` points met whose inner product is largest (-1 where fewer), and its negative.

    A bit for each query and point tells which were met, so that no distance is taken twice; queries go in runs that
    keep this table under `SEEN_BYTES`.
    """
    run = max(1, SEEN_BYTES // max(1, len(points)))
    if len(queries) > run:
        parts = [beam_search(graph, points, queries[s : s + run], entry, beam, width) for s in range(0, len(queries), run)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    m = len(queries)
    ids = np.full((m, beam), -1, np.int32)
    dist = np.full((m, beam), np.inf, np.float32)
    done = np.ones((m, beam), bool)
    seen = np.zeros((m, len(points)), bool)
    ids[:, 0], done[:, 0], seen[:, entry] = entry, False, True
    dist[:, 0] = -(queries @ points[entry])
    while len(act := np.flatnonzero(~done.all(axis=1))):
        pick = np.argsort(np.where(done[act], np.inf, dist[act]), axis=1)[:, :width]
        at, node = [], []
        for k in range(pick.shape[1]):
            rows = np.flatnonzero(~done[act, pick[:, k]])
            done[act[rows], pick[rows, k]] = True
            near = graph[ids[act[rows], pick[rows, k]]]
            r, c = np.nonzero((near >= 0) & ~seen[act[rows][:, None], near])
            at.append(rows[r])
            node.append(near[r, c])
            seen[act[at[-1]], node[-1]] = True
        at, node = np.concatenate(at), np.concatenate(node)
        d = -np.einsum("ij,ij->i", points[node], queries[act[at]])
        better = np.flatnonzero(d < dist[act[at], -1])
        by = better[np.argsort(at[better], kind="stable")]
        at, node, d = at[by], node[by], d[by]
        count = np.bincount(at, minlength=len(act))
        place = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        more_ids = np.full((len(act), int(count.max())), -1, np.int32)
        more_d = np.full(more_ids.shape, np.inf, np.float32)
        more_ids[at, place], more_d[at, place] = node, d
        all_d = np.concatenate([dist[act], more_d], axis=1)
        best = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        dist[act] = np.take_along_axis(all_d, best, axis=1)
        ids[act] = np.take_along_axis(np.concatenate([ids[act], more_ids], axis=1), best, axis=1)
        done[act] = np.take_along_axis(np.concatenate([done[act], more_ids < 0], axis=1), best, axis=1)
    return ids, dist


def robust_prune(points: np.ndarray, of: np.ndarray, candidates: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """For each point of `of`, from its candidates (-1: none): the nearest, then the nearest not covered by one chosen."""
    x = points[candidates]
    d = ((x - points[of][:, None, :]) ** 2).sum(axis=2)
    n2 = (x * x).sum(axis=2)
    apart = n2[:, :, None] + n2[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
    alive = (candidates >= 0) & (candidates != of[:, None])
    out = np.full((len(of), degree), -1, np.int32)
    rows = np.arange(len(of))
    for k in range(degree):
        if not alive.any():
            break
        best = np.where(alive, d, np.inf).argmin(axis=1)
        some = alive[rows, best]
        out[some, k] = candidates[rows, best][some]
        alive &= ~(some[:, None] & (alpha * apart[rows, best] <= d))
        alive[rows, best] = False
    return out


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """The graph over points of length 1 (points x degree, -1: no edge) and its entry, the point nearest the middle."""
    n = len(points)
    graph = np.full((n, degree), -1, np.int32)
    entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    at = 1
    while at < n:
        new = order[at : at + min(INSERT, at)]
        at += len(new)
        found, _ = beam_search(graph, points, points[new], entry, beam)
        graph[new] = robust_prune(points, new, found, degree, alpha)
        to, source = graph[new].ravel(), np.repeat(new, degree)
        source, to = source[to >= 0], to[to >= 0]
        by = np.argsort(to, kind="stable")
        hubs, first, count = np.unique(to[by], return_index=True, return_counts=True)
        have = (graph[hubs] >= 0).sum(axis=1)
        for lo, hi in ((0, degree), (degree, 2 * degree), (2 * degree, 4 * degree), (4 * degree, n + degree)):
            part = np.flatnonzero((have + count > lo) & (have + count <= hi))
            for s in range(0, len(part), 256 if hi <= 4 * degree else 4):
                p = part[s : s + (256 if hi <= 4 * degree else 4)]
                more = np.full((len(p), int(count[p].max())), -1, np.int32)
                for r, j in enumerate(p):
                    more[r, : count[j]] = source[by[first[j] : first[j] + count[j]]]
                both = np.concatenate([graph[hubs[p]], more], axis=1)
                if lo == 0:
                    both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)[:, :degree]
                    graph[hubs[p]] = np.pad(both, ((0, 0), (0, degree - both.shape[1])), constant_values=-1)
                else:
                    graph[hubs[p]] = robust_prune(points, hubs[p], both, degree, alpha)
    return graph, entry


def directions(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1, as they point; scaled first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))).astype(np.float32)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    good = vectors.where("vec_id is not null and embedding is not null and size(embedding) > 0").select(F.col("vec_id").cast("long"), v.alias("v"))
    return good.where(F.forall("v", finite) & F.exists("v", lambda x: x != 0))


def build_index(good: DataFrame, k: int, shard_points: int = SHARD_POINTS) -> tuple[DataFrame, DataFrame]:
    """One row per distinct vector: n (components), shard, node, v, vec_ids (the k + 1 smallest), edges; and (n, shards)."""
    smallest = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    distinct = good.distinct().withColumn("nth", smallest).where(F.col("nth") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("vec_ids"))
    distinct = written(distinct.withColumn("n", F.size("v")))
    shards = written(distinct.groupBy("n").agg(F.ceil(F.count("*") / shard_points).cast("int").alias("shards")))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("first").reset_index(drop=True)
        graph, entry = build(directions(np.stack(pdf["v"].to_numpy())))
        return pd.DataFrame({"n": pdf["n"], "shard": pdf["shard"], "node": pdf.index, "entry": entry, "v": pdf["v"], "vec_ids": pdf["vec_ids"], "edges": list(graph)})

    dealt = distinct.join(shards, "n").withColumn("shard", F.pmod(F.xxhash64("v"), F.col("shards")).cast("int")).withColumn("first", F.col("vec_ids")[0])
    index = dealt.groupBy("n", "shard").applyInPandas(grow, "n int, shard int, node int, entry int, v array<double>, vec_ids array<long>, edges array<int>")
    return written(index), shards


def search(index: DataFrame, shards: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM) -> DataFrame:
    """queries (query_id, q) -> query_id, rank, vec_id, score: the k nearest found, the query's own id left out.

    Every query meets every shard of its number of components, in blocks: a task holds one shard's graph and one block of queries.
    """
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    number = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = index.withColumn("block", number(F.lit(blocks)))
    right = queries.withColumns({"n": F.size("q"), "block": F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")}).join(shards, "n").withColumn("shard", number(F.col("shards")))

    def walk(graph: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if graph.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        graph = graph.sort_values("node")
        v = np.stack(graph["v"].to_numpy())
        q = np.stack(asked["q"].to_numpy())
        edges, ids, owners = np.stack(graph["edges"].to_numpy()), graph["vec_ids"].to_numpy(), asked["query_id"].to_numpy()
        scaled = np.abs(v).max(), np.abs(q).max(axis=1, keepdims=True)  # single precision must hold them
        found, _ = beam_search(edges, (v / scaled[0]).astype(np.float32), (q / scaled[1]).astype(np.float32), int(graph["entry"].iloc[0]), min(beam, len(v)))
        out = []
        for i, own in enumerate(owners):
            hits = found[i][found[i] >= 0]
            scores = v[hits] @ q[i]
            best: dict[int, float] = {}
            for s, h in zip(scores.tolist(), hits, strict=True):
                for x in ids[h]:
                    if x != own:
                        best[x] = max(s, best.get(x, s))
            out += [(own, x, -s) for s, x in sorted((-s, x) for x, s in best.items())[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ["n", "shard", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(walk, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The k nearest of each row whose vec_id is divisible by `every`, among all other rows."""
    good = written(usable(vectors))
    index, shards = build_index(good, k)
    queries = good.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))
    return search(index, shards, queries, k)
