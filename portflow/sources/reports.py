"""Folders of CSV files: one all-or-nothing load per file.

Each file is read by its own header and by the state of its quotes (see `records`). Every cell is text; columns that are not expected are
ignored, expected ones that are absent are NULL. A file of no bytes, or of a header alone, is a load without rows. Each file's
rows are read once: they are written aside, counted there, and moved into place if their load is good.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portflow.operators import ledger
from portflow.sources import records
from portflow.sources.folders import file_system, files_in, names_in, shared_dir
from portflow.sources.registry import SourceSpec, source
from portflow.specs import LoadStatus, LoadType

REPORT = source(LoadType.VESSEL_REPORT)
COLUMNS = list(REPORT.columns)
INPUT = re.compile(r"(?i)(?!~\$).*\.csv")


def inputs(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name -> path of a folder's CSV files, lock files (~$...) left out, by name."""
    return {n: p for n, p in files_in(spark, folder).items() if INPUT.fullmatch(n)}


def read_files(spark: SparkSession, files: dict[str, str], columns: list[str] = COLUMNS) -> DataFrame:
    """(source_name, row_no and columns) as text of files (name -> path); row_no follows the order of the file."""
    return records.read_files(spark, files, columns)


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    return read_files(spark, inputs(spark, folder))


def numbered_loads(names: DataFrame, loads: DataFrame) -> DataFrame:
    """A load id for each name, after the largest there is, in the order of the names."""
    start = loads.agg(F.coalesce(F.max("load_id"), F.lit(0))).first()[0]
    order = F.row_number().over(Window.orderBy("source_name"))  # one row per file
    return names.select("source_name", (order + start).cast("long").alias("load_id"))


def numbers_in_names(names: DataFrame, loads: DataFrame) -> DataFrame:
    """The number that ends each name as its load id, so that files that come late sort where they belong. No number, no id."""
    number = F.expr(r"try_cast(nullif(regexp_extract(source_name, '([0-9]+)[.][a-zA-Z]+$', 1), '') as long)")
    return names.select("source_name", number.alias("load_id"))


def ingest_files(spark: SparkSession, files: dict[str, str], raw_path: str, loads: DataFrame, spec: SourceSpec = REPORT, ids=numbered_loads) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lands files (name -> path): (outcome per file, new ledger rows, error rows).

    Raw rows are moved into place first, one partition per load, then the caller appends the ledger rows: readers take only loads in
    the ledger, so a load that was cut off half-way is not seen and is overwritten by its next try. A load id that the ledger
    has for another name, or that two of the files claim, fails. Skipped and refused files are not read: their n_rows is 0.
    """
    shared_dir(spark)
    names = spark.createDataFrame([(n,) for n in files], "source_name string")
    load_ids = ids(names, loads)
    claimed = loads.where(F.col("load_status_id") != int(LoadStatus.ERROR)).select("load_id", F.col("source_name").alias("holder"))
    twice = F.count("*").over(Window.partitionBy("load_id")) > 1  # one row per file
    load_ids = load_ids.withColumn("twice", F.col("load_id").isNotNull() & twice).join(claimed, "load_id", "left")
    refused = F.when(F.col("load_id").isNull(), "no number in the name").when(
        F.col("twice") | (F.col("holder").isNotNull() & (F.col("holder") != F.col("source_name"))), "its number belongs to another file"
    )
    named = names.join(load_ids, "source_name").withColumn("refused", refused).select("source_name", "load_id", "refused")
    named = named.join(ledger.ingested_names(loads), "source_name", "left").checkpoint()  # one row per file
    wanted = {r["source_name"] for r in named.where("refused is null and seen is null").select("source_name").collect()}
    raw = read_files(spark, {n: p for n, p in files.items() if n in wanted}, list(spec.columns))
    typed = spec.shape(raw.join(F.broadcast(named.select("source_name", "load_id")), "source_name"))
    aside = f"{raw_path}/_aside-{uuid.uuid4().hex}"  # a name that readers of raw_path do not see
    typed.withColumn("load", F.col("load_id")).write.partitionBy("load").parquet(aside)
    written = spark.read.schema(typed.schema).parquet(aside)
    counts = written.groupBy("load_id").agg(F.count("*").alias("n_rows"), F.sum(F.least("bad_cells", F.lit(1))).alias("n_bad"))
    sized = named.join(counts, "load_id", "left").select("source_name", "load_id", "refused", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_bad", F.lit(0)).alias("n_bad"))
    outcome = ledger.ingest_outcome(sized, loads).join(sized.select("source_name", "load_id", "refused"), "source_name")
    outcome = outcome.withColumn("outcome", F.when(F.col("refused").isNotNull() & (F.col("outcome") != "skipped"), "failed").otherwise(F.col("outcome"))).checkpoint()
    promote(spark, aside, raw_path, {r["load_id"] for r in outcome.where("outcome = 'ingested'").select("load_id").collect()})
    status = F.when(F.col("outcome") == "ingested", int(LoadStatus.INGESTED)).otherwise(int(LoadStatus.ERROR))
    new = outcome.where("outcome <> 'skipped'").select("load_id", "source_name", F.current_timestamp().alias("date_loaded"), F.lit(int(spec.load_type)).alias("load_type_id"), status.alias("load_status_id"))
    why = F.coalesce("refused", F.concat(F.col("n_bad").cast("string"), F.lit(" unreadable rows")))
    errors = outcome.where("outcome = 'failed'").select(
        F.concat(F.col("source_name"), F.lit(": "), why).alias("error_message"), F.lit("ingest_files").alias("error_procedure"), F.current_timestamp().alias("error_datetime")
    )
    return outcome.select("source_name", "load_id", "n_rows", "n_bad", "outcome"), new, errors


def promote(spark: SparkSession, aside: str, raw_path: str, load_ids: set[int]) -> None:
    """Loads written aside take their places, one directory each, and what is there of a try that was cut off goes; the others are removed."""
    fs, folder = file_system(spark, aside)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for name in names_in(spark, aside, folders=True):
        if name.startswith("load=") and int(name[5:]) in load_ids:
            target = path(f"{raw_path}/load_id={name[5:]}")
            fs.delete(target, True)
            if not fs.rename(path(f"{aside}/{name}"), target):
                raise OSError(f"{aside}/{name} can't be moved to {target}")
    fs.delete(folder, True)


def ingest_folder(spark: SparkSession, folder: str, raw_path: str, loads: DataFrame, spec: SourceSpec = REPORT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lands what a folder holds, as ingest_files does."""
    return ingest_files(spark, inputs(spark, folder), raw_path, loads, spec)


def land(rows: DataFrame, path: str) -> None:
    """Overwrites the loads that rows hold, and no other."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(path)


def scan(spark: SparkSession, path: str, load_ids: list[int]) -> DataFrame:
    """Rows of some loads: partitions of other loads are not read."""
    return spark.read.parquet(path).where(F.col("load_id").isin(load_ids))


def landed(spark: SparkSession, path: str, loads: DataFrame) -> DataFrame:
    """Rows of loads that the ledger has and has not marked as failed."""
    good = loads.where(F.col("load_status_id") != int(LoadStatus.ERROR)).select("load_id")
    return spark.read.parquet(path).join(good, "load_id", "left_semi")

