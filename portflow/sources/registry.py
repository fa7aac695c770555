"""What is known of each source: how its files read, how its rows are shaped, and what they become.

A new source is one more entry; readers, validation and processing take what they need from it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.operators import process, reshape
from portflow.specs import GATE, MEASURES, ON_TERMINAL, OUT_OF_SERVICE, REPORT_TEXT, STREET_USE, FactSpec, LoadType


@dataclass(frozen=True)
class SourceSpec:
    """columns: the text columns of its CSV files (none: rows are staged by others); shape: raw rows to typed ones; fact: None for voyages."""

    name: str
    load_type: LoadType
    shape: Callable[[DataFrame], DataFrame]
    columns: tuple[str, ...] = ()
    fact: FactSpec | None = None


SOURCES = {
    s.load_type: s
    for s in (
        SourceSpec("voyage", LoadType.VESSEL_REPORT, reshape.clean_report, (*REPORT_TEXT, "work_date", "worktime", *(m[0] for m in MEASURES), "reported")),
        SourceSpec("gate_activity", LoadType.GATE_ACTIVITY, reshape.gate_activity, fact=GATE),
        SourceSpec("on_terminal", LoadType.ON_TERMINAL, reshape.counted_equipment, fact=ON_TERMINAL),
        SourceSpec("out_of_service", LoadType.OUT_OF_SERVICE, reshape.counted_equipment, fact=OUT_OF_SERVICE),
        SourceSpec("street_use_days", LoadType.STREET_USE_DAYS, reshape.street_use, fact=STREET_USE),
    )
}


def source(load_type: int) -> SourceSpec:
    if load_type not in SOURCES:
        raise KeyError(f"no source of load type {load_type}")
    return SOURCES[load_type]


def process_loads(loads: DataFrame, raw: dict[int, DataFrame]) -> tuple[process.Processed, dict[str, DataFrame]]:
    """Processes what is pending of every load type in raw (its raw rows): the run, and the states by name.

    States: voyages, details, fields, and one for each fact. Types that raw does not name stay as they are.
    """
    runs, states, now = [], {}, loads
    for load_type, rows in raw.items():
        spec = source(load_type)
        typed = spec.shape(rows)
        run = process.run_fact(now, typed, load_type) if spec.fact else process.run_voyages(now, typed)
        runs.append(run)
        now = run.loads
        if spec.fact:
            states[spec.name] = process.facts(run, typed, spec.fact)
        else:
            states |= {"voyages": process.voyages(run, typed), "details": process.details(run, typed), "fields": process.fields(run, typed)}
    together = lambda part: reduce(DataFrame.unionByName, (getattr(r, part) for r in runs))
    return process.Processed(now, together("events"), together("errors"), together("good")), states


def errors_of(run: process.Processed) -> DataFrame:
    """The run's error rows as the error log has them."""
    return run.errors.select(F.col("message").alias("error_message"), F.lit("process_loads").alias("error_procedure"), F.current_timestamp().alias("error_datetime"))
