"""Best-fit packing by minimum bin slack.

Documents become runs of token ids that end in an end mark; only runs longer than a sequence are cut. Bins are then
filled one after the other: the longest piece left goes in, and a bitset subset-sum over the lengths left finds the
fullest way to use the rest, which is removed. All that this looks at is how many pieces there are of each length, at
most as many numbers as a sequence has tokens, so the plan is made from that histogram while pieces stay where they
are; equal bins are planned once, with the number of times the counts allow. Each piece then finds its place from its
rank among the pieces of its length.

Null text counts as empty and gives a piece that holds the end mark alone. Repeated rows are packed each for itself, as are
rows that share an id or have none. Pieces of one length are alike to the plan: which of them takes which place follows no
rule. Without documents there is no sequence. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portflow.llm import bpe
from portflow.llm.shared import written

CAPACITY, END_ID = 2048, 0
BLOCK_CHARS = 6_000_000
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = _PIECE + ", sequence_id long, offset long"


def cut(encoded: pa.Table, capacity: int = CAPACITY, end_id: int = END_ID) -> pa.Table:
    """(doc_id, ids) as pieces of at most `capacity` ids, the end mark counted."""
    rows = []
    for part in encoded.to_batches():
        ids, doc = part.column("ids"), part.column("doc_id").to_pylist()
        offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<u4")
        for i, d in enumerate(doc):
            own = np.append(values[offsets[i] : offsets[i + 1]], np.uint32(end_id)).astype("<u4")
            for k, at in enumerate(range(0, len(own), capacity)):
                piece = own[at : at + capacity]
                rows.append((d, k, at, len(piece), crc32(piece.tobytes())))
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths whose sum is the largest within `room`: length -> how many.

    Bit s of `sums` says that some combination reaches s. Counts are taken in powers of two; as soon as `room`
    itself is reached, no more lengths are looked at. The steps kept on the way lead back to the combination.
    """
    mask, sums, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, many = min(counts[length], room // length), 1
        while left:
            many = min(many, left)
            grown = sums | ((sums << (length * many)) & mask)
            if grown != sums:
                steps.append((length, many, sums))
                sums = grown
            left, many = left - many, many * 2
        if sums >> room & 1:
            break
    at, chosen = sums.bit_length() - 1, {}
    for length, many, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + many
            at -= length * many
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, first sequence, pieces of that length per sequence, offset of the first of them)."""
    left, used, rows, sequence = {x: n for x, n in histogram.items() if n}, dict.fromkeys(histogram, 0), [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = fullest(left, capacity - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times, at = min(left[x] // n for x, n in chosen.items()), 0
        for x in sorted(chosen, reverse=True):
            rows.append((x, used[x], sequence, chosen[x], at))
            at += x * chosen[x]
            used[x] += chosen[x] * times
            left[x] -= chosen[x] * times
            if not left[x]:
                del left[x]
        sequence += times
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and its place there.

    The driver gets the histogram of lengths, `capacity` rows at most. Ranks are counted in hashed parts of each
    length, so that the many pieces of a common length share tasks.
    """
    spark, parts = pieces.sparkSession, max(16, int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pieces = written(pieces.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts))))
    sizes = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = np.array(sorted(plan(histogram, capacity)) or np.zeros((0, 5)), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(table)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(within) - 1).join(sizes, ["length", "part"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        starts = rows[:, 0] << 44 | rows[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = rows[np.searchsorted(starts, length << 44 | rank, side="right") - 1]
            nth = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(row[:, 2] + nth // row[:, 3]), pa.array(row[:, 4] + nth % row[:, 3] * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).cast("long").alias("rank")).mapInArrow(place, _PLACED)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(bpe.encode(docs, path, then=lambda t: cut(t, capacity), schema=_PIECE, block_chars=BLOCK_CHARS), capacity)
