"""The life of a voyage: on the report, off the report, called or canceled, back again."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portflow.functions import clean
from portflow.specs import FIELDS, FactSpec, VoyageStatus

VOYAGE = FactSpec(("voyage",), ("work_date", "worktime", "reported_at"))


def files_of(report: DataFrame) -> DataFrame:
    """The loads with the load after each. One row per load; an empty file is a row too if the caller's frame has it."""
    return follow(report.select("load_id").distinct())


def follow(files: DataFrame) -> DataFrame:
    return files.select("load_id", F.lead("load_id").over(Window.orderBy("load_id")).alias("next_file"))


def appearances(report: DataFrame, files: DataFrame) -> DataFrame:
    """Each appearance of a voyage with what came of it: status is NULL unless it fell off the next file and can be classified.

    Whether it fell off follows from the files, not from rows: a file without rows drops every voyage.
    """
    last = F.max(F.struct("row_no", "work_date", "worktime", "reported_at")).alias("x")
    seen = report.where("voyage is not null").groupBy("voyage", "load_id").agg(last).select("voyage", "load_id", "x.work_date", "x.worktime", "x.reported_at")
    seen = seen.join(files, "load_id").withColumn("next_seen", F.lead("load_id").over(Window.partitionBy("voyage").orderBy("load_id")))
    fell = F.col("next_file").isNotNull() & (F.col("next_seen").isNull() | (F.col("next_seen") != F.col("next_file")))
    return seen.withColumn("fell_off", fell).withColumn("status", F.when(fell, clean.classify(F.col("work_date"), F.col("reported_at"))))


def status_current(report: DataFrame, files: DataFrame) -> DataFrame:
    """By the last appearance of each voyage, combined before the shuffle: it fell off if there is a file after it."""
    rows = report.where("voyage is not null").select("voyage", "load_id", "row_no", "work_date", "worktime", "reported_at")
    last = F.max(F.struct("load_id", "row_no", "work_date", "worktime", "reported_at", "next_file")).alias("x")
    seen = rows.join(F.broadcast(files), "load_id").groupBy("voyage").agg(last).select("voyage", "x.*")  # files: a row each
    status = F.when(F.col("next_file").isNotNull(), clean.classify(F.col("work_date"), F.col("reported_at")))
    return seen.select("voyage", "load_id", "work_date", F.coalesce(status, F.lit(int(VoyageStatus.TO_CALL))).alias("voyage_status_id"))


def fallen_off(report: DataFrame, files: DataFrame) -> DataFrame:
    return appearances(report, files).where("fell_off").select("voyage", "load_id", F.col("next_file").alias("missing_from"), F.col("status").alias("voyage_status_id"))


def status_timeline(report: DataFrame, files: DataFrame) -> DataFrame:
    """Versions (voyage, load_id, voyage_status_id, valid_from, valid_to): to call from each appearance, its outcome from the file it is missing from."""
    seen = appearances(report, files)
    settled = F.col("status").isNotNull()
    to_call = seen.select(
        "voyage", "load_id", F.lit(int(VoyageStatus.TO_CALL)).alias("voyage_status_id"), F.col("load_id").alias("valid_from"),
        F.when(settled, F.col("next_file")).otherwise(F.col("next_seen")).alias("valid_to"),
    )
    outcome = seen.where(settled).select("voyage", "load_id", F.col("status").alias("voyage_status_id"), F.col("next_file").alias("valid_from"), F.col("next_seen").alias("valid_to"))
    return to_call.unionByName(outcome).withColumn("closed", F.col("valid_to").isNotNull())


def not_in_file(report: DataFrame, files: DataFrame, load_id: int) -> DataFrame:
    """Voyages to call before a file that are not in it; if the file has no rows, all of them."""
    before = status_timeline(report, files).where((F.col("voyage_status_id") == 1) & (F.col("valid_from") < load_id) & (F.col("valid_to").isNull() | (F.col("valid_to") >= load_id)))
    return before.join(report.where(F.col("load_id") == load_id).select("voyage"), "voyage", "left_anti").select("voyage", "load_id")


def reported_dates(report: DataFrame, pairs: DataFrame) -> DataFrame:
    """(load_id, voyage, reported_at) for the pairs asked for; unreadable dates drop out, the last duplicate wins."""
    rows = report.where("reported_at is not null").join(pairs, ["load_id", "voyage"], "left_semi")
    return rows.groupBy("load_id", "voyage").agg(F.max_by("reported_at", "row_no").alias("reported_at"))


def live_details(details: DataFrame, current: DataFrame) -> DataFrame:
    return details.join(current.select("voyage", "load_id"), ["voyage", "load_id"], "left_semi")


def past_details(details: DataFrame, current: DataFrame) -> DataFrame:
    return details.join(current.select("voyage", "load_id"), ["voyage", "load_id"], "left_anti")


def field_map(fields: DataFrame) -> DataFrame:
    """The latest value that is not blank, for each voyage and field type."""
    return fields.groupBy("voyage", "field_type_id").agg(F.max_by("field_value", F.struct("load_id", "row_no")).alias("field_value"))


def report_fields(report: DataFrame) -> DataFrame:
    """field_map() of a report's fields, found before they are unpivoted: what is sorted by voyage is one row a report row, not one a field."""
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("load_id", "row_no"))).alias(c)
    latest = report.groupBy("voyage").agg(*(last(c) for c, _ in FIELDS))
    pairs = F.explode(F.array(*(F.struct(F.lit(t).alias("field_type_id"), F.col(c).alias("field_value")) for c, t in FIELDS))).alias("p")  # six a voyage
    return latest.select("voyage", pairs).select("voyage", "p.*").where("field_value is not null")
