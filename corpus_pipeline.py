"""The corpus pipeline: documents in, packed training sequences out, in five stages.

Every stage is a function (spark, docs, sf_dir) over all that the stage before it kept. All but the last return the
columns of documents; columns beside those are left out. What a stage returns is written as Parquet and read again as the next one's documents, so a
lost executor never reaches back beyond its own stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.llm import langid, line_dedup, packing, secrets, simhash
from portflow.llm.shared import salted_join, shared_dir, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no fitted language can be made out go; the others carry the language that was found.

    Null, empty and blank texts, and texts without letters, go. Repeated rows are judged each for itself, long texts whole. A null
    source is no host. Ties between languages go to the first by name.
    """
    model = langid.fit_text_model(docs)
    found = langid.identify_documents(docs.select(*COLUMNS), model)
    return found.where("text_lang is not null and lang_found <> 'und'").withColumn("lang", F.col("lang_found")).select(*COLUMNS)


def line_frequency(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go from all its documents; every document stays.

    The source is the site, as documents have no address. A document that is boilerplate throughout is a copy and stays as it is:
    the next stage keeps one of its group. A null text stays null, an empty one empty; a null source is a source.
    """
    pages = docs.select(F.col("doc_id").alias("page"), F.col("source").alias("host"), "text", "lang", "n_chars")
    return _recounted(line_dedup.drop_boilerplate(pages, keep_whole=True).withColumnsRenamed({"page": "doc_id", "host": "source"}))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose five-word shingles are similar to 0.8 or more the one with the smallest doc_id stays
    (null comes last; of rows that share it, the one whose digest is the smallest).

    Null, empty and blank texts are one group. Repeated rows are copies, and so are different texts under one doc_id only if
    they are similar.
    """
    rows = written(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()))
    found = simhash.similar_groups(rows)
    ids = rows.select("row", "doc_id", F.xxhash64("text").alias("h"))
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "digest", "h", "row")
    placed = written(found.join(ids, "row"))
    best = placed.groupBy("root").agg(F.min(order).alias("best"), F.count("*").alias("n")).where("n > 1").select("root", F.col("best.row").alias("keep"))
    gone = written(salted_join(placed.select("root", "row"), best, "root", "row").where("row <> keep").select("row"))  # far fewer than stay
    return rows.join(gone, "row", "left_anti").select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in place, overlapping ones as the first of them; every document stays, null texts as null."""
    return _recounted(secrets.redact(docs.select(*COLUMNS)))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences; a null or empty text is one piece that holds the end mark alone."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_frequency),
    ("simhash_near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the fitted language model nor fingerprints, tokenizer and packing; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
