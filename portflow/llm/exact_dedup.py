"""Exact deduplication as a tree-merge of sorted digest runs.

Each partition that keys its documents is a run, sorted by digest: for each digest the best row and the number of rows.
Runs are exchanged in binomial rounds: in each, runs whose numbers agree but for their last FAN_IN_BITS bits meet and are
merged in order of digest, until one run is left, spread over all tasks by digest. No merge sees more than the fan-in's
number of entries of a digest, whatever the size of its group. The winners go the same way back, from the last round to
the first, where each row finds its own. The number of rounds follows the number of partitions.

A digest is the SHA-256 of the text without the characters of [\\x20\\x09-\\x0D]. At every level entries merge, and keep the
smallest identifier, only if what verifies a digest agrees too: that text's length and a second hash of it of another
family. Of equal texts, the row with the most code points stays, then the one with the smallest doc_id (null comes last),
then one of the rows that are the same in both. Null text counts as empty, which equals all blank ones. Repeated rows are
rows of their own. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.llm.shared import SPACES, text_of, written

FAN_IN_BITS = 3
#: What makes two texts one: the digest and what verifies it.
KEY = ["digest", "size", "check"]
_PARTITION_BITS = 33  # monotonically_increasing_id: the partition's number stands above so many bits


def keyed(docs: DataFrame) -> DataFrame:
    """One narrow row per document, in sorted runs: KEY of the normalised text, code points, a number of its own, its run."""
    bare = F.regexp_replace(text_of(), f"[{SPACES}]+", "")
    rows = docs.select(F.col("doc_id").cast("long"), bare.alias("bare"), F.length(text_of()).alias("points"))
    rows = rows.select("doc_id", "points", F.sha2("bare", 256).alias("digest"), F.length("bare").alias("size"), F.xxhash64("bare").alias("check"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("run", F.shiftright("row", _PARTITION_BITS).cast("int"))
    return written(rows.sortWithinPartitions("run", *KEY))


def merge_round(runs: DataFrame, bits: int) -> DataFrame:
    """Merges the runs that differ in their last `bits` bits only."""
    return runs.groupBy(F.shiftright("run", bits).alias("run"), *KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def tree_merge(rows: DataFrame, fan_in_bits: int = FAN_IN_BITS) -> DataFrame:
    """rows of keyed() with keep_id, keep_row and group_size."""
    last = rows.agg(F.max("run")).first()[0] or 0
    best = F.struct((-F.col("points")).alias("fewer"), F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    levels = [rows.withColumn("best", best).groupBy("run", *KEY).agg(F.min("best").alias("best"), F.count("*").alias("n"))]
    for _ in range(-(-last.bit_length() // fan_in_bits)):
        levels.append(merge_round(levels[-1], fan_in_bits))
    won = levels.pop()
    for level in reversed(levels):
        own = level.select(F.col("run").alias("to"), F.shiftright("run", fan_in_bits).alias("run"), *KEY)
        won = own.join(won, ["run", *KEY]).select(F.col("to").alias("run"), *KEY, "best", "n")
    found = rows.join(won, ["run", *KEY])
    return found.select("doc_id", "row", "digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), F.col("n").alias("group_size"))


def exact_groups(docs: DataFrame) -> DataFrame:
    found = tree_merge(keyed(docs))
    return found.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.col("digest").alias("text_sha256"))
