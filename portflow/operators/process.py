"""The processing run: what is pending is validated, and what passes becomes voyages, details, fields and facts.

Ledgers are broadcast, a row a load, so that rows of other loads go before anything is grouped. A load counts as a whole or not at all: a rejected one changes no voyage, drops none from the report and leaves an error
row and a failed status. State is derived from the rows of all loads that count, so that a run that is repeated, or goes on
after it was cut off, comes to the same state; rows are keyed by load, and nothing is written twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.operators import ledger, reshape, validate, versions, voyage
from portflow.sources.folders import shared_dir
from portflow.specs import MEASURES, FactSpec, LoadStatus, LoadType


@dataclass(frozen=True)
class Processed:
    """Frames of a run. loads: the ledger after it; events: its steps; errors: (load_id, message); good: load ids that count."""

    loads: DataFrame
    events: DataFrame
    errors: DataFrame
    good: DataFrame


def pending(loads: DataFrame, load_type: int) -> DataFrame:
    """The loads of a type that a run takes: vessel reports wherever they stopped, other types if ingested."""
    status = ledger.QUEUE if load_type == LoadType.VESSEL_REPORT else (LoadStatus.INGESTED,)
    return loads.where((F.col("load_type_id") == int(load_type)) & F.col("load_status_id").isin([int(s) for s in status]))


def _run(loads: DataFrame, load_type: int, rejects: Callable[[DataFrame], DataFrame]) -> Processed:
    """rejects: (load_id, message) from the ids of the loads that are taken; rows of other loads are not validated."""
    shared_dir(loads.sparkSession)
    taken = pending(loads, load_type)
    errors = rejects(taken.select("load_id")).select("load_id", "message").checkpoint()  # validation runs once
    events = ledger.steps(taken, errors).checkpoint()  # a few rows a load
    after = events.groupBy("load_id").agg(F.max_by("status", "seq").alias("now"))
    now = loads.join(after, "load_id", "left").withColumn("load_status_id", F.coalesce("now", "load_status_id")).drop("now")
    last = LoadStatus.DONE if load_type == LoadType.VESSEL_REPORT else LoadStatus.DETAILS
    good = now.where((F.col("load_type_id") == int(load_type)) & (F.col("load_status_id") == int(last))).select("load_id")
    return Processed(now, events, errors, good)


def run_voyages(loads: DataFrame, report: DataFrame, details: DataFrame | None = None, measures: Iterable[tuple] = MEASURES) -> Processed:
    """report: typed rows of vessel reports (clean_report); details: their measures, if made by another mapping than voyage_details; measures: the
    mapping, if no details are given."""

    def rejects(taken: DataFrame) -> DataFrame:
        rows = report.join(F.broadcast(taken), "load_id", "left_semi")
        found = None if details is None else details.join(F.broadcast(taken), "load_id", "left_semi")
        return validate.rejected(validate.voyage_problems(rows, found, measures))

    return _run(loads, LoadType.VESSEL_REPORT, rejects)


def run_fact(loads: DataFrame, rows: DataFrame, load_type: int) -> Processed:
    """rows: mapped rows of one fact. Cells that can't be read and gate types that do not exist reject their load."""
    checks = [f for c, f in (("bad_cells", validate.unreadable), ("gate_type_id", validate.unknown_gate_types)) if c in rows.columns]

    def rejects(taken: DataFrame) -> DataFrame:
        if not checks:
            return taken.select("load_id", F.lit("").alias("message")).limit(0)
        some = rows.join(F.broadcast(taken), "load_id", "left_semi")
        found = reduce(DataFrame.unionByName, (f(some) for f in checks))
        return found.groupBy("load_id").agg(F.array_join(F.sort_array(F.collect_list("message")), "; ").alias("message"))  # two at most

    return _run(loads, load_type, rejects)


def voyages(run: Processed, report: DataFrame) -> DataFrame:
    """The status of every voyage, by the files that count: those without rows drop voyages too, rejected ones drop none."""
    rows = report.join(F.broadcast(run.good), "load_id", "left_semi")
    return voyage.status_current(rows, voyage.follow(run.good))


def details(run: Processed, report: DataFrame) -> DataFrame:
    """The measures of every voyage's latest appearance, coded."""
    rows = report.join(F.broadcast(run.good), "load_id", "left_semi")
    return reshape.coded_details(voyage.live_details(reshape.voyage_details(rows), versions.current(rows, voyage.VOYAGE)))


def fields(run: Processed, report: DataFrame) -> DataFrame:
    return voyage.report_fields(report.join(F.broadcast(run.good), "load_id", "left_semi"))


def facts(run: Processed, rows: DataFrame, spec: FactSpec) -> DataFrame:
    return versions.current(rows.join(F.broadcast(run.good), "load_id", "left_semi"), spec)
