"""The shared dimension: (field type, text) -> id, and ids of other systems."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portflow.functions import clean
from portflow.sources.folders import shared_dir
from portflow.sources.store import Store
from portflow.specs import FIELD_TYPES, FactSpec


#: Buckets of a stored dictionary.
BUCKETS = 32


def field_types(spark: SparkSession) -> DataFrame:
    schema = "field_type_id int, name string, ext_table string, ext_search_column string, ext_id_column string, ext_where string, notif_flag boolean"
    return spark.createDataFrame(FIELD_TYPES, schema)


def names_of(rows: DataFrame, spec: FactSpec) -> DataFrame:
    """Distinct (field_type_id, value) of a fact's name columns."""
    pairs = F.explode(F.array(*(F.struct(F.lit(t).alias("field_type_id"), F.col(c).alias("value")) for c, t in spec.names))).alias("p")
    return rows.select(pairs).select("p.*").where("value is not null").distinct()


def numbered(new: DataFrame, keys: list[str], start: int = 0, parts: int = 64) -> DataFrame:
    """new with ids start + 1, start + 2, ...: ranks within hashed parts, each after the parts before it. No task sees all rows."""
    new = new.withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(parts)))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = new.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(*keys))
    return new.withColumn("rank", rank).join(F.broadcast(sizes), "part").withColumn("id", (F.lit(start) + F.col("before") + F.col("rank")).cast("long")).drop("part", "rank", "before")  # `parts` rows


def find_or_create(known: DataFrame | None, names: DataFrame) -> DataFrame:
    """known (id, field_type_id, value, external_id, notif_flag) and a row for each new name: known ids stay, new ones follow the largest.

    A new row takes the flag of its type and has no external id.
    """
    spark, keys = names.sparkSession, ["field_type_id", "value"]
    new, start = names.select(*keys).distinct(), 0
    if known is not None:
        new = new.join(known, keys, "left_anti")
        start = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    types = field_types(spark).select("field_type_id", "notif_flag")
    made = numbered(new, keys, start).join(F.broadcast(types), "field_type_id").select("id", *keys, F.lit(None).cast("long").alias("external_id"), "notif_flag")
    return made if known is None else known.unionByName(made)


def find_or_create_values(known: DataFrame | None, names: DataFrame) -> DataFrame:
    """known (id, value) and a row for each new text, whatever its types: one id a text."""
    new, start = names.select("value").distinct(), 0
    if known is not None:
        new = new.join(known, "value", "left_anti")
        start = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    made = numbered(new, ["value"], start).select("id", "value")
    return made if known is None else known.unionByName(made)


DIMENSION = "id long, field_type_id int, value string, external_id long, notif_flag boolean"
_COUNTER = "next long"


def reserve(store: Store, n: int) -> int:
    """The first of n ids that nobody else gets: the counter is published anew, and of two who read it alike one has to read it again."""
    while True:
        m = store.manifest()
        owner = m.owners("ids").get("next", (None,))[0]
        first = store.read("ids", _COUNTER, m).first()
        first = first["next"] if first else 1
        counter = store.spark.createDataFrame([(first + n,)], _COUNTER)
        if store.publish([store.stage("ids", counter, F.lit("next"), {"next": owner})]):
            return first


def find_or_create_stored(store: Store, names: DataFrame, buckets: int = BUCKETS) -> int:
    """Names (field_type_id, value) that the stored dictionary lacks are added; tells how many. Two runs at once give each name one id.

    The dictionary is in buckets by hash of the name: only those that new names fall in are written. Ids are reserved in blocks before they are
    used; a run that finds another's names in its buckets looks again, and what it had reserved stays unused.
    """
    types = field_types(names.sparkSession).select("field_type_id", "notif_flag")
    bucket = F.pmod(F.xxhash64("field_type_id", "value"), F.lit(buckets)).cast("string")
    keys = ["field_type_id", "value"]
    names = names.select(*keys).where("value is not null").distinct()
    while True:
        m = store.manifest()
        owners = m.owners("dimension")
        known = store.read("dimension", DIMENSION, m)
        new = names.join(known.select(*keys), keys, "left_anti").checkpoint()
        touched = {r[0]: r[1] for r in new.groupBy(bucket.alias("bucket")).count().collect()}  # a row a bucket
        n = sum(touched.values())
        if not n:
            return 0
        made = numbered(new, keys, reserve(store, n) - 1).join(F.broadcast(types), "field_type_id").select("id", *keys, F.lit(None).cast("long").alias("external_id"), "notif_flag")
        rows = store.read("dimension", DIMENSION, m, touched).unionByName(made)
        if store.publish([store.stage("dimension", rows, bucket, {b: owners.get(b, (None,))[0] for b in touched})]):
            return n


def stored_dimension(store: Store) -> DataFrame:
    return store.read("dimension", DIMENSION)


def resolve(rows: DataFrame, dimension: DataFrame, spec: FactSpec) -> DataFrame:
    """rows with <name>_id for each name column; NULL stays NULL."""
    for column, kind in spec.names:
        ids = dimension.where(F.col("field_type_id") == kind).select(F.col("value").alias(column), F.col("id").alias(f"{column}_id"))
        rows = rows.join(ids, column, "left")
    return rows


def values_of(dimension: DataFrame, field_type_id: int) -> DataFrame:
    return dimension.where(F.col("field_type_id") == field_type_id).select("value", "id")


def _external(field_type_id: int, external: DataFrame) -> DataFrame:
    """(field_type_id, value, found, n) of one type's configured table, column and filter."""
    _, _, _, search, key, where, _ = next(k for k in FIELD_TYPES if k[0] == field_type_id)
    missing = {search, key} - set(external.columns)
    if missing:
        raise ValueError(f"no such column: {sorted(missing)}")
    found = external.where(F.expr(where)) if where else external
    found = found.groupBy(F.col(search).alias("value")).agg(F.min(key).cast("long").alias("found"), F.count("*").alias("n"))
    return found.select(F.lit(field_type_id).alias("field_type_id"), "value", "found", "n")


def resolve_externals(dimension: DataFrame, externals: dict[int, DataFrame]) -> DataFrame:
    """Sets external_id of the types in externals by exact match; no match is NULL. One join for all types.

    Types without configuration, and those not asked for, are left alone. If several rows match, the smallest id is taken
    and n_matches tells.
    """
    out = dimension if "n_matches" in dimension.columns else dimension.withColumn("n_matches", F.lit(None).cast("long"))
    configured = {k[0] for k in FIELD_TYPES if k[2] is not None}
    asked = {k: v for k, v in externals.items() if k in configured}
    if not asked:
        return out
    found = reduce(DataFrame.unionByName, (_external(k, v) for k, v in asked.items()))
    own = F.col("field_type_id").isin(list(asked))
    out = out.join(found, ["field_type_id", "value"], "left")
    out = out.withColumn("external_id", F.when(own, F.col("found")).otherwise(F.col("external_id")))
    return out.withColumn("n_matches", F.when(own, F.coalesce("n", F.lit(0))).otherwise(F.col("n_matches"))).drop("found", "n")


def resolve_external(dimension: DataFrame, field_type_id: int, external: DataFrame | None) -> DataFrame:
    return resolve_externals(dimension, {} if external is None else {field_type_id: external})


def set_notif_flag(types: DataFrame, dimension: DataFrame, field_type_id: int, flag: bool) -> tuple[DataFrame, DataFrame]:
    """The flag of a type, and with it that of all its values."""
    new = F.when(F.col("field_type_id") == field_type_id, F.lit(flag)).otherwise(F.col("notif_flag"))
    return types.withColumn("notif_flag", new), dimension.withColumn("notif_flag", new)


def to_notify(dimension: DataFrame) -> DataFrame:
    return dimension.where("external_id is null and notif_flag")


def trimmed_names(frames: Iterable[tuple[DataFrame, FactSpec]]) -> DataFrame:
    """Distinct (field_type_id, value) of the name columns of several facts, trimmed: once a name and not once a row, and kept, as those who number names read them several times."""
    out = reduce(DataFrame.unionByName, (names_of(rows, spec) for rows, spec in frames))
    shared_dir(out.sparkSession)
    return out.select("field_type_id", clean.text(F.col("value")).alias("value")).where("value is not null").distinct().checkpoint()
