"""The load ledger: one row per file, its status, the queue of what is pending."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.specs import LoadStatus, LoadType

#: Where the queue starts: details written, then voyages written, then ingested.
QUEUE = (LoadStatus.DETAILS, LoadStatus.VOYAGES, LoadStatus.INGESTED)


def by_id(loads: DataFrame, load_id: int) -> DataFrame:
    """The load of an id: one row, or none."""
    return loads.where(F.col("load_id") == load_id)


def by_status(loads: DataFrame, status: int) -> DataFrame:
    return loads.where(F.col("load_status_id") == int(status)).orderBy("load_id")


def by_type_and_status(loads: DataFrame, load_type: int, status: int) -> DataFrame:
    return loads.where((F.col("load_type_id") == int(load_type)) & (F.col("load_status_id") == int(status))).orderBy("load_id")


def earliest_by_name(loads: DataFrame, without: int = LoadStatus.ERROR) -> DataFrame:
    """The first load of each name, loads of a status left out (those without a status too, as in SQL)."""
    return loads.where(F.col("load_status_id") != int(without)).groupBy("source_name").agg(F.min(F.struct("load_id", "load_type_id", "load_status_id")).alias("x")).select("source_name", "x.*")


def queue(loads: DataFrame) -> DataFrame:
    priority = F.coalesce(*(F.when(F.col("load_status_id") == int(s), F.lit(k)) for k, s in enumerate(QUEUE)))
    return loads.withColumn("priority", priority).where("priority is not null").orderBy("priority", "load_id")


def routed(loads: DataFrame, asked: DataFrame, load_type: int = LoadType.VESSEL_REPORT) -> DataFrame:
    """asked (load_id) as what processing each as one type comes to: (load_id, outcome, load_status_id, message).

    unknown: no such load. rejected: of another type, which marks the load as failed; or a vessel report that is done, which
    changes nothing. processed: all others, failed ones too, which are tried again. load_status_id: the status without the processing itself.
    """
    load_type = int(load_type)
    found = asked.select("load_id").join(loads.select("load_id", "load_type_id", "load_status_id", F.lit(True).alias("there")), "load_id", "left")
    other = F.col("load_type_id").isNull() | (F.col("load_type_id") != load_type)
    done = (F.lit(load_type) == int(LoadType.VESSEL_REPORT)) & (F.col("load_status_id") == int(LoadStatus.DONE))
    number = F.col("load_id").cast("string")
    message = (
        F.when(F.col("there").isNull(), F.concat(F.lit("there is no load "), number))
        .when(done, F.concat(F.lit("load "), number, F.lit(" is done already")))
        .when(other, F.concat(F.lit("load "), number, F.lit(f" is not of type {load_type}")))
    )
    outcome = F.when(F.col("there").isNull(), "unknown").when(done | other, "rejected").otherwise("processed")
    status = F.when(F.col("there") & ~done & other, int(LoadStatus.ERROR)).otherwise(F.col("load_status_id"))
    return found.select("load_id", outcome.alias("outcome"), status.cast("int").alias("load_status_id"), message.alias("message"))


def process_next(loads: DataFrame, n: int) -> DataFrame:
    """The next n of the queue with their outcome; loads of other types than vessel reports are skipped, and count."""
    outcome = F.when(F.col("load_type_id") == int(LoadType.VESSEL_REPORT), "processed").otherwise("skipped")
    return queue(loads).limit(n).withColumn("outcome", outcome)


def summary(loads: DataFrame) -> DataFrame:
    failed = F.count_if(F.col("load_status_id") == int(LoadStatus.ERROR))
    return loads.agg(F.count("*").alias("total"), failed.alias("failed"), (F.count("*") - failed).alias("imported"))


def opening(loads: DataFrame) -> DataFrame:
    """The ledger as events (load_id, seq, status): what was so before anything else happened."""
    return loads.select("load_id", F.lit(0).alias("seq"), F.col("load_status_id").cast("int").alias("status"))


def steps(loads: DataFrame, rejects: DataFrame) -> DataFrame:
    """Events (load_id, seq, status) of processing loads (load_id, load_type_id, load_status_id); those in rejects end as failed.

    A vessel report goes on from where it stopped: voyages, details, done. Other types go from ingested to details, their last status.
    """
    path = [int(s) for s in (LoadStatus.VOYAGES, LoadStatus.DETAILS, LoadStatus.DONE)]
    at = F.when(F.col("load_status_id").isin(path[:2]), F.col("load_status_id")).otherwise(int(LoadStatus.INGESTED))
    voyage = F.filter(F.array(*map(F.lit, path)), lambda s: s > at)
    status = (
        F.when(F.col("failed"), F.array(F.lit(int(LoadStatus.ERROR))))
        .when(F.col("load_type_id") == int(LoadType.VESSEL_REPORT), voyage)
        .otherwise(F.array(F.lit(int(LoadStatus.DETAILS))))
    )
    marked = loads.join(rejects.select("load_id", F.lit(True).alias("failed")), "load_id", "left")
    return marked.select("load_id", F.posexplode(status).alias("pos", "status")).select("load_id", (F.col("pos") + 1).alias("seq"), "status")


def current_status(events: DataFrame) -> DataFrame:
    return events.groupBy("load_id").agg(F.max_by("status", "seq").alias("load_status_id"), F.count("*").alias("n_steps"))


def ingested_names(loads: DataFrame) -> DataFrame:
    """(source_name, seen) of loads that have not failed."""
    return loads.where(F.col("load_status_id") != int(LoadStatus.ERROR)).select("source_name").distinct().withColumn("seen", F.lit(True))


def ingest_outcome(files: DataFrame, loads: DataFrame) -> DataFrame:
    """files (source_name, n_rows, n_bad): skipped if a load of that name has not failed, failed on any bad row, else ingested."""
    seen = ingested_names(loads)
    outcome = F.when(F.col("seen"), "skipped").when(F.col("n_bad") > 0, "failed").otherwise("ingested")
    return files.join(seen, "source_name", "left").select("source_name", "n_rows", "n_bad", outcome.alias("outcome"))


def merge_seed(existing: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """Inserts what is missing, leaves what is there."""
    return existing.unionByName(seed.join(existing, key, "left_anti"))
