"""What several operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.sources.folders import shared_dir

__all__ = ["SPACES", "checkpointed", "components", "salted_join", "shared_dir", "table", "text_of", "written"]

#: The characters that separate words in every contract here: blank and U+0009 to U+000D.
SPACES = "\x20\x09-\x0d"


def written(df: DataFrame) -> DataFrame:
    """df, written as Parquet in the shared folder and read again: lineage is cut, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of a small table; Spark removes its files once nothing refers to it."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def text_of(column: str = "text") -> F.Column:
    """Null counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: str, salts: int = 8) -> DataFrame:
    """Inner join on key, of which left may have any number of rows each and right one: left's are dealt by `spread` to copies of right's."""
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).join(copies, [key, "_salt"]).drop("_salt")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (u, v): one row per node, (node, root), root the smallest node reachable.

    Alternating large-star and small-star rounds, until one changes nothing. Each round is grouped aggregation over the edges
    and ends in a checkpoint; links never reach the driver, only the sum that tells whether a round changed anything.
    Minima are combined before they are shuffled, and the edges of a node that many share are joined to it in salted parts.
    """

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = checkpointed(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before, now = None, digest(edges)
    while now != before:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = salted_join(both.where("v > u"), low, "u", "v").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            salted_join(large, low, "u", "v").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(low.select("u", F.col("m").alias("v")))
            .where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        )
        edges = checkpointed(small)
        before, now = now, digest(edges)
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
