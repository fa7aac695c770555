"""Token counts as delta-maintained rollups.

A change row inserts, deletes, revises or moves the count of one document under one tokenizer version. A batch of changes
is first summed by (source, language, tokenizer version); its signed sums are written aside and then published under the
batch's number in one manifest (see `portflow.sources.store`). What no manifest names is not there, so a driver lost at any moment
leaves nothing to see and nothing in the way, and a batch that is in is not committed again, before or after a
compaction. Of two writers of one batch one is told False. A fold names the folders that it replaces, and is void if another fold took
one of them. Totals add up what the folders hold; batch numbers are kept as ranges.

Null keys are keys of their own; a null text counts 0 tokens. Repeated rows count as often as they occur. An empty batch
commits an empty set of sums. Other columns are ignored. Without commits there are no totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.llm import bpe
from portflow.llm.shared import SPACES, text_of, written
from portflow.sources.store import Staged, Store

#: Tokenizer versions that are patterns: what one token is. BPE is the version of the vocabulary of operator 3.
TOKENIZERS = {"words-1": f"[^{SPACES}]+", "marks-2": f"[0-9A-Za-z]+|[^{SPACES}0-9A-Za-z]"}
BPE = "word-bpe-49k"
KEYS = ["source", "lang", "tokenizer"]
_SUMS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
_TABLE, _STREAM = "sums", "batch"


def count_tokens(text: F.Column, tokenizer: str) -> F.Column:
    return F.regexp_count(text, F.lit(TOKENIZERS[tokenizer])).cast("long")


def counted(docs: DataFrame, tokenizer: str) -> DataFrame:
    return docs.select("doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"), count_tokens(text_of(), tokenizer).alias("n_tokens"))


def counted_bpe(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The counts of the BPE tokenizer. Rows get numbers of their own, as they may share a doc_id."""
    rows = written(docs.select("doc_id", "source", "lang", "text").withColumn("row", F.monotonically_increasing_id()))
    sizes = bpe.encode(rows.select(F.col("row").alias("doc_id"), "text"), path).select(F.col("doc_id").alias("row"), F.size("ids").cast("long").alias("n_tokens"))
    return rows.drop("text").join(sizes, "row").select("doc_id", "source", "lang", F.lit(BPE).alias("tokenizer"), "n_tokens")


def inserts(counts: DataFrame) -> DataFrame:
    return counts.withColumns({"d_docs": F.lit(1), "d_tokens": F.col("n_tokens")})


def deletes(counts: DataFrame) -> DataFrame:
    return counts.withColumns({"d_docs": F.lit(-1), "d_tokens": -F.col("n_tokens")})


def revisions(counts: DataFrame, old: str = "old_tokens", new: str = "n_tokens") -> DataFrame:
    """The same documents under the same keys, counted anew."""
    return counts.withColumns({"d_docs": F.lit(0), "d_tokens": F.col(new) - F.col(old)})


def moves(counts: DataFrame, key: str, to: F.Column) -> DataFrame:
    """The same counts under another key: out there, in here."""
    return deletes(counts).unionByName(inserts(counts.withColumn(key, to)))


class Rollup:
    """Signed sums in folders, and the manifests that say which of them count."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.store = spark, Store(spark, path)

    def folders(self) -> list[str]:
        return sorted(e["folder"] for e in self.store.manifest().entries(_TABLE))

    def write_sums(self, changes: DataFrame, replaces: list[str] | None = None) -> Staged:
        sums = changes.groupBy(*KEYS).agg(F.sum("d_docs").cast("long").alias("n_docs"), F.sum("d_tokens").cast("long").alias("n_tokens"))
        return self.store.stage(_TABLE, sums, replaces=replaces or ())

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """changes: KEYS, d_docs, d_tokens. False if this batch is in already, or another writer was first: nothing is done then."""
        if self.store.manifest().has(_STREAM, batch):
            return False
        return self.store.publish([self.write_sums(changes)], _STREAM, batch)

    def totals(self, folders: list[str] | None = None) -> DataFrame:
        """KEYS, n_docs, n_tokens; keys whose documents are all gone have left too."""
        sums = self.store.read(_TABLE, _SUMS, folders=folders)
        return sums.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> bool:
        """One folder in the place of all there are; totals stay. False if there is nothing to fold or another fold was first. Folded folders go when the store is vacuumed."""
        old = self.folders()
        if len(old) < 2:
            return False
        return self.store.publish([self.write_sums(self.totals(old).withColumnsRenamed({"n_docs": "d_docs", "n_tokens": "d_tokens"}), old)])
