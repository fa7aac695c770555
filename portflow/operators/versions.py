"""Last-wins upsert by null-safe identity, over an append-only log of versions.

Rows of one identity are ordered by (load_id, row_no), never by arrival, so that a late load lands where it belongs.
Rows that agree in both, which no source makes, fall to the larger payload, so that the result is
the same on every run. `current` and `collapse` are aggregations that combine before the shuffle; only the history needs a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portflow.specs import FactSpec


def _latest(rows: DataFrame, keys: list[str], spec: FactSpec) -> DataFrame:
    last = F.max(F.struct("load_id", "row_no", *spec.payload)).alias("last")
    return rows.groupBy(*keys).agg(last)


def collapse(rows: DataFrame, spec: FactSpec) -> DataFrame:
    """One row per load and identity: the last of the load."""
    out = _latest(rows, ["load_id", *spec.identity], spec)
    return out.select("load_id", *spec.identity, *(f"last.{c}" for c in ("row_no", *spec.payload)))


def current(rows: DataFrame, spec: FactSpec) -> DataFrame:
    """One row per identity: the last of all loads. Grouping takes NULLs as equal."""
    out = _latest(rows, list(spec.identity), spec)
    return out.select(*spec.identity, *(f"last.{c}" for c in ("load_id", "row_no", *spec.payload)))


def upsert(existing: DataFrame, batch: DataFrame, spec: FactSpec) -> DataFrame:
    """existing, a current(), after a batch: the same as current() of all rows, in whatever order batches come."""
    columns = [*spec.identity, "load_id", "row_no", *spec.payload]
    return current(existing.select(*columns).unionByName(batch.select(*columns)), spec)


def timeline(rows: DataFrame, spec: FactSpec) -> DataFrame:
    """Every version with valid_from and valid_to, the load that replaced it (NULL: live)."""
    identity = Window.partitionBy(*spec.identity).orderBy("load_id")
    out = collapse(rows, spec).withColumn("valid_to", F.lead("load_id").over(identity))
    return out.select(*spec.identity, F.col("load_id").alias("valid_from"), "valid_to", *spec.payload)


def history(rows: DataFrame, spec: FactSpec) -> DataFrame:
    return timeline(rows, spec).where("valid_to is not null")


def as_of(versions: DataFrame, load_id: int) -> DataFrame:
    return versions.where((F.col("valid_from") <= load_id) & (F.col("valid_to").isNull() | (F.col("valid_to") > load_id)))


def as_of_points(timeline: DataFrame, points: DataFrame, identity: list[str], width: int, at: str = "at") -> DataFrame:
    """points with the version of their identity that was valid at `at`: points' columns, valid_from, valid_to and what else the timeline has.

    No pairs are made. What is asked for, each identity and time once however many points share it, is run through with the versions in
    order, and the last version before a time is its own; points then take theirs by an equality join. An identity's time is cut into buckets
    of `width`, each a group of its own; what a bucket begins with is the last version of those before it. Points before the first version,
    and where a version had ended without another, drop out. NULL identities are equal.
    """
    others = [c for c in timeline.columns if c not in identity]
    version, points = F.struct(*others), points.where(F.col(at).isNotNull())  # here, so that both uses of points are one to Spark
    bucket = lambda c: ((F.col(c) - F.pmod(F.col(c), F.lit(width))) / width).cast("long").alias("_bucket")
    starts = timeline.select(*identity, bucket("valid_from"), F.col("valid_from").cast("long").alias("_t"), version.alias("_version"))
    asked = points.select(*identity, F.col(at).cast("long").alias("_t")).distinct().select(*identity, bucket("_t"), "_t", F.lit(True).alias("_asked"))
    # the last version of each bucket, and with it the first of the next ones that hold anything
    ends = starts.select(*identity, "_bucket", "_t", "_version").unionByName(asked.select(*identity, "_bucket", "_t"), allowMissingColumns=True)
    ends = ends.groupBy(*identity, "_bucket").agg(F.max(F.when(F.col("_version").isNotNull(), F.struct("_t", "_version"))).alias("_last"))
    before = Window.partitionBy(*identity).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*identity, "_bucket", F.last("_last", ignorenulls=True).over(before).alias("_last")).where("_last is not null")
    carried = carried.select(*identity, "_bucket", "_last._t", "_last._version")
    every = starts.unionByName(carried).unionByName(asked, allowMissingColumns=True)
    order = Window.partitionBy(*identity, "_bucket").orderBy("_t", F.col("_asked").isNotNull())
    found = every.withColumn("_version", F.last("_version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    held = F.col("_version.valid_to").isNull() | (F.col("_version.valid_to") > F.col("_t"))
    found = found.where(F.col("_asked") & F.col("_version").isNotNull() & held).select(*identity, "_t", "_version").alias("v")
    on = F.col(f"p.{at}").cast("long") == F.col("v._t")
    for c in identity:
        on = on & F.col(f"p.{c}").eqNullSafe(F.col(f"v.{c}"))
    return points.alias("p").join(found, on).select("p.*", *(F.col(f"v._version.{c}") for c in others))


def affected(existing: DataFrame, batch: DataFrame, spec: FactSpec) -> DataFrame:
    """Existing rows of the batch's dates only."""
    return existing.join(batch.select(spec.dated).distinct(), spec.dated, "left_semi")


def actions(existing: DataFrame, batch: DataFrame, spec: FactSpec) -> DataFrame:
    """The batch's rows, collapsed, with action insert or update."""
    now = current(batch, spec).alias("b")
    old = affected(existing, batch, spec).select(*spec.identity, F.lit(True).alias("known")).alias("e")
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"e.{c}")) for c in spec.identity]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return now.join(old, on, "left").select("b.*", F.when(F.col("known"), "update").otherwise("insert").alias("action"))
