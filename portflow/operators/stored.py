"""State that is kept between runs: facts by business date, voyages by file, versions in tiers, and the run that stores what it decides.

Each step reads and rewrites only what its batch touches. Steps are idempotent by batch, and two that meet are done one after the other.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portflow.functions import clean
from portflow.operators import ledger, process, reshape, versions, voyage
from portflow.sources.store import Manifest, Staged, Store
from portflow.specs import MEASURES, REPORT_TEXT, FactSpec, VoyageStatus

NO_DAY = "none"


def _schema(rows: DataFrame) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)


# ---------------------------------------------------------------- facts by date


def day_of(spec: FactSpec) -> Column:
    return F.coalesce(F.date_format(F.col(spec.dated), "yyyy-MM-dd"), F.lit(NO_DAY))


def stage_upsert(store: Store, m: Manifest, table: str, batch: DataFrame, spec: FactSpec) -> Staged:
    """The batch's days as they are after it: what the store has of those days, and no other, is read, merged and written aside."""
    columns = [*spec.identity, "load_id", "row_no", *spec.payload]
    with store.aside(versions.current(batch.select(*columns), spec).select(*columns)) as batch:
        days = sorted(r[0] for r in batch.select(day_of(spec)).distinct().collect())  # a row a day
        owners = m.owners(table)
        known = store.read(table, _schema(batch), m, days)
        return store.stage(table, versions.upsert(known, batch, spec).select(*columns), day_of(spec), {d: owners.get(d, (None,))[0] for d in days}, days)


def upsert(store: Store, table: str, batch: DataFrame, spec: FactSpec, stream: str | None = None, number: int | None = None) -> bool:
    """The batch merged into a stored fact, whatever its order among batches. False if a batch of this number is in already."""
    return _until_stored(store, lambda m: [stage_upsert(store, m, table, batch, spec)], stream, number)


def _until_stored(store: Store, step: Callable[[Manifest], list[Staged]], stream: str | None, number: int | None) -> bool:
    """A step whose premises fell to another writer is done again on what is there now."""
    while True:
        m = store.manifest()
        if stream is not None and m.has(stream, number):
            return False
        if store.publish(step(m), stream, number):
            return True


def stored_facts(store: Store, table: str, like: DataFrame, spec: FactSpec, days: Iterable[str] | None = None) -> DataFrame:
    """The fact as it is now; of some days only, if these are given. like: a frame with its columns."""
    columns = [*spec.identity, "load_id", "row_no", *spec.payload]
    return store.read(table, _schema(like.select(*columns)), keys=days)


# ---------------------------------------------------------------- voyages by file

APPEARANCES = "voyage string, load_id long, work_date date, reported_at timestamp, next_file long, fell_off boolean, status int"
#: Load ids that share a partition: for numbers made of dates, a month.
SPAN = 100


def _files(store: Store, m: Manifest, table: str) -> list[int]:
    """The files that a table has taken in, by load id: a number a file, as in the ledger."""
    return sorted(r["load_id"] for r in store.read(f"{table}_files", "load_id long", m).distinct().collect())


def stage_voyages(store: Store, m: Manifest, table: str, report: DataFrame, files: Iterable[int], span: int = SPAN) -> list[Staged]:
    """New files (load ids) and their rows taken into the voyages' appearances, `span` load ids a partition.

    What becomes of an appearance depends on the next file alone. So a new file, be it the last or one that comes late, is held
    against its neighbours: its own appearances against the file after it, those of the file before it against the new one. A
    file without rows counts as one. Only the partitions of these files are written, and only those and their successors' read.
    """
    known = _files(store, m, table)
    files = sorted(set(files) - set(known))
    if not files:
        return []
    every, owners = sorted({*known, *files}), m.owners(table)
    touched = {known[i - 1] for f in files if (i := bisect_left(known, f)) > 0} | set(files)
    parts = {f // span for f in touched}
    follows = {f: every[i + 1] if i + 1 < len(every) else None for i, f in enumerate(every) if f // span in parts}
    looked = {str(f // span) for f in [*follows, *follows.values()] if f is not None}
    last = F.max(F.struct("row_no", "work_date", "reported_at")).alias("x")
    new = report.join(F.broadcast(store.spark.createDataFrame([(f,) for f in files], "load_id long")), "load_id", "left_semi").where("voyage is not null").groupBy("voyage", "load_id").agg(last).select("voyage", "load_id", "x.work_date", "x.reported_at")
    ours = new.unionByName(store.read(table, APPEARANCES, m, looked).select(*new.columns))
    order = store.spark.createDataFrame(list(follows.items()), "load_id long, next_file long")
    # a voyage is in the next file if that is where it is seen next: `ours` is gone through once, and not held against itself
    next_seen = F.lead("load_id").over(Window.partitionBy("voyage").orderBy("load_id"))
    seen = ours.withColumn("next_seen", next_seen).join(F.broadcast(order), "load_id")  # order: a row a file of the partitions
    fell = F.col("next_file").isNotNull() & (F.col("next_seen").isNull() | (F.col("next_seen") != F.col("next_file")))
    status = F.when(fell, clean.classify(F.col("work_date"), F.col("reported_at")))
    rows = seen.select("voyage", "load_id", "work_date", "reported_at", "next_file", fell.alias("fell_off"), status.alias("status"))
    key = F.expr(f"(load_id - pmod(load_id, {span})) div {span}").cast("string")
    premises = {k: owners.get(k, (None,))[0] for k in looked | set(map(str, parts))}
    taken = store.spark.createDataFrame([(f,) for f in files], "load_id long").coalesce(1)
    return [store.stage(table, rows, key, premises, map(str, parts)), store.stage(f"{table}_files", taken)]


def advance_voyages(store: Store, table: str, report: DataFrame, files: Iterable[int], stream: str | None = None, number: int | None = None, span: int = SPAN) -> bool:
    """A step of one file or several. Files that are in already, and their rows, change nothing."""
    files = list(files)
    done = _until_stored(store, lambda m: stage_voyages(store, m, table, report, files, span), stream, number)
    store.merge_tiers(f"{table}_files", "load_id long", merged=lambda rows: rows.coalesce(1))
    return done


def stored_status(store: Store, table: str) -> DataFrame:
    """(voyage, load_id, work_date, voyage_status_id) by each voyage's last appearance."""
    rows = store.read(table, APPEARANCES)
    last = rows.groupBy("voyage").agg(F.max(F.struct("load_id", "work_date", "status")).alias("x"))
    return last.select("voyage", "x.load_id", "x.work_date", F.coalesce("x.status", F.lit(int(VoyageStatus.TO_CALL))).alias("voyage_status_id"))


def still_to_call(store: Store, table: str, span: int = SPAN) -> DataFrame:
    """Voyages of the last file; only its partition is read."""
    m = store.manifest()
    last = max(_files(store, m, table), default=0)
    return store.read(table, APPEARANCES, m, [str(last // span)]).where(F.col("load_id") == last).select("voyage", "load_id", "work_date")


# ---------------------------------------------------------------- versions in tiers


def append_versions(store: Store, table: str, rows: DataFrame, spec: FactSpec, stream: str, number: int, fanout: int = 4) -> bool:
    """One more batch of a fact's versions; those that have gathered are merged. `versions.history` and `versions.current` of what is read stay the same."""
    columns = [*spec.identity, "load_id", "row_no", *spec.payload]
    batch = versions.collapse(rows, spec).select(*columns)
    if store.manifest().has(stream, number):
        return False
    done = store.publish([store.stage(table, batch)], stream, number)
    store.merge_tiers(table, _schema(batch), fanout, lambda r: versions.collapse(r, spec).select(*columns))
    return done


# ---------------------------------------------------------------- the processing run

LOADS = "load_id long, source_name string, load_type_id int, load_status_id int"
EVENTS = "load_id long, seq long, status int"
ERRORS = "load_id long, message string"
_DETAILS = "load_id long, row_no long, voyage string, equipment_id int, direction_id int, mode_id int, loaded boolean, containers int"
_REPORT = ("load_id", "row_no", *REPORT_TEXT, "work_date", "reported_at", *(m[0] for m in MEASURES))
_FIELDS = "load_id long, row_no long, voyage string, field_type_id int, field_value string"


def register(store: Store, loads: DataFrame, stream: str = "register", number: int = 0) -> bool:
    """New ledger rows (LOADS), once by their number."""
    return False if store.manifest().has(stream, number) else store.publish([store.stage("loads", loads.select("load_id", "source_name", "load_type_id", "load_status_id"))], stream, number)


def ledger_of(store: Store, m: Manifest | None = None) -> DataFrame:
    """The loads as they are now: what they were registered with, and the last step since."""
    m = m or store.manifest()
    steps = store.read("events", EVENTS, m).groupBy("load_id").agg(F.max_by("status", "seq").alias("now"))
    return store.read("loads", LOADS, m).join(steps, "load_id", "left").withColumn("load_status_id", F.coalesce("now", "load_status_id")).drop("now")


def process_stored(store: Store, errors: Store, sources: dict[int, tuple[DataFrame, FactSpec | None, str]], stream: str = "process", number: int = 0) -> bool:
    """What is pending is validated and stored: facts, voyages, details, fields and the ledger's steps in one commit.

    sources: load type -> (typed rows, fact or None for vessel reports, table). Only rows of pending loads are read. Errors are
    published first, in a log of their own, so that they stay when the commit fails; a run that is tried again tells them again
    under the same number, which adds nothing.
    """

    def step(m: Manifest) -> list[Staged]:
        loads, staged, steps = ledger_of(store, m), [], []
        for load_type, (rows, spec, table) in sources.items():
            wanted = process.pending(loads, load_type).select("load_id").checkpoint()  # a row a load
            some = rows.join(F.broadcast(wanted), "load_id", "left_semi")
            # reports are read four times; columns that nothing here reads are left out, as the generated method would get too large to be compiled
            with nullcontext(some) if spec else store.aside(some.select(*_REPORT)) as some:
                run = process.run_fact(loads, some, load_type) if spec else process.run_voyages(loads, some)
                steps.append(run.events)
                if not errors.manifest().has(f"{stream}-{int(load_type)}", number):
                    errors.publish([errors.stage("errors", run.errors)], f"{stream}-{int(load_type)}", number)
                passed = wanted.join(run.errors, "load_id", "left_anti")
                good = some.join(F.broadcast(passed), "load_id", "left_semi")
                if spec:
                    staged.append(stage_upsert(store, m, table, good, spec))
                    continue
                files = [r["load_id"] for r in passed.collect()]  # a number a new file
                staged += stage_voyages(store, m, table, good, files)
                staged.append(store.stage("details", reshape.coded_details(reshape.voyage_details(good))))
                staged.append(store.stage("fields", reshape.voyage_fields(good)))
        first = 1000 * (m.version + 1)
        for events in steps:
            staged.append(store.stage("events", events.select("load_id", (F.col("seq") + first).cast("long").alias("seq"), F.col("status").cast("int").alias("status"))))
        return staged

    done = _until_stored(store, step, stream, number)
    for table, schema in (("details", _DETAILS), ("fields", _FIELDS), ("events", EVENTS)):
        store.merge_tiers(table, schema)
    errors.merge_tiers("errors", ERRORS)
    return done


def live_details(store: Store, table: str) -> DataFrame:
    """The measures of every voyage's latest appearance."""
    last = stored_status(store, table).select("voyage", "load_id")
    return store.read("details", _DETAILS).join(last, ["voyage", "load_id"], "left_semi")


def field_map(store: Store) -> DataFrame:
    return voyage.field_map(store.read("fields", _FIELDS))


def steps_of(store: Store) -> DataFrame:
    """The ledger as events: what each load was registered with, and every step since."""
    m = store.manifest()
    return ledger.opening(store.read("loads", LOADS, m)).withColumn("seq", F.col("seq").cast("long")).unionByName(store.read("events", EVENTS, m))
