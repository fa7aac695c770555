"""Every operator over the driver's tables: a plan for Spark and the same in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.functions import clean
from portflow.operators import dims, ledger, process, reshape, stored, validate, versions, voyage
from portflow.plans.bridge import BRIDGES, raw, table, with_bridges
from portflow.sources import folders, reports
from portflow.sources import registry as sources
from portflow.sources.store import Store
from portflow.specs import EQUIPMENT, FIELDS, GATE, LOCATION, MEASURES, OCEAN_CARRIER, ON_TERMINAL, OUT_OF_SERVICE, REPORT_TEXT, STREET_USE, FactSpec, LoadStatus, LoadType

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = with_bridges(sql)
        return f

    return add


# ---------------------------------------------------------------- shared SQL

_TEXT = ", ".join(f"nullif(trim({c}), '') as {c}" for c in REPORT_TEXT)
_INTS = ", ".join(f"try_cast(nullif(trim({m[0]}), '') as int) as {m[0]}" for m in MEASURES)
_REPORTED = "coalesce(try_strptime(nullif(trim(reported), ''), '%m%d%Y%H%M'), try_strptime(nullif(trim(reported), ''), '%m%d%Y'))"
_CLEAN = f"""select cast(load_id as bigint) as load_id, row_no, {_TEXT}, cast(try_strptime(nullif(trim(work_date), ''), '%Y%m%d') as date) as work_date,
  cast(null as varchar) as worktime, {_INTS}, nullif(trim(reported), '') as reported, {_REPORTED} as reported_at from gpa_raw"""
_SEEN = f"""c as ({_CLEAN}), f as (select load_id, lead(load_id) over (order by load_id) as next_file from (select distinct load_id from c)),
 seen as (select voyage, load_id, work_date, reported_at, next_file, lead(load_id) over (partition by voyage order by load_id) as next_seen from c join f using (load_id)),
 fell as (select *, next_file is not null and (next_seen is null or next_seen <> next_file) as fell_off,
  case when work_date <= cast(reported_at as date) + 1 then 2 when work_date > cast(reported_at as date) + 1 then 3 end as outcome from seen)"""
_DETAILS = " union all ".join(
    f"select load_id, row_no, voyage, {f"'{e}'" if e else 'cast(null as varchar)'} as equipment_name, '{d}' as direction, '{m}' as mode, {bool(x)} as loaded, {c} as containers from c where {c} <> 0"
    for c, e, d, m, x in MEASURES
)
_FIELDS = " union all ".join(f"select load_id, row_no, voyage, {t} as field_type_id, {c} as field_value from c where {c} is not null" for c, t in FIELDS)
_GATE = """select cast(load_id as bigint) as load_id, row_no, date, nullif(trim(trucker_name), '') as trucker_name, nullif(trim(equip_code), '') as equip_code, equip_length, length_match_id,
 nullif(trim(ocean_carrier_name), '') as ocean_carrier_name, try_cast(nullif(trim(gate_type), '') as int) as gate_type_id, bare_chassis_flag, container_loaded_flag,
 nullif(trim(location_name), '') as location_name, units, transactions from gate_raw"""
_ON = "select cast(load_id as bigint) as load_id, row_no, date, nullif(trim(equip_code), '') as equip_code, nullif(trim(location_name), '') as location_name, units from {}"
_STREET = """select cast(load_id as bigint) as load_id, row_no, out_gate_date, nullif(trim(out_gate_location), '') as out_gate_location, in_gate_date, nullif(trim(in_gate_location), '') as in_gate_location,
 nullif(trim(equipment_code), '') as equipment_code, nullif(trim(ultimate_user), '') as ultimate_user, count_of_records from street_raw"""
FACTS = {
    "gate_activity": (GATE, reshape.gate_activity, "gate_raw", _GATE),
    "on_terminal": (ON_TERMINAL, reshape.counted_equipment, "on_term_raw", _ON.format("on_term_raw")),
    "out_of_service": (OUT_OF_SERVICE, reshape.counted_equipment, "oos_raw", _ON.format("oos_raw")),
    "street_use_days": (STREET_USE, reshape.street_use, "street_raw", _STREET),
}
_LEDGER = """loads as (select load_id, concat('report_', cast(load_id % 500 as varchar), '.csv') as source_name, cast(1 + load_id % 7 as int) as load_type_id,
 cast(case load_id % 5 when 0 then 2 when 1 then 3 when 2 then 4 when 3 then 5 else 99 end as int) as load_status_id from (select distinct cast(load_id as bigint) as load_id from gpa_raw))"""


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.clean_report(raw(spark, sf_dir, "gpa_raw"))


def load_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loads of gpa_raw, from the one column that makes them: the bridge itself is not built for them."""
    day = F.col("l_shipdate").cast("date")
    number = F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    return table(spark, sf_dir, "lineitem").select(number.cast("long").alias("load_id")).where("load_id is not null").distinct()


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voyage.follow(load_ids(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spec, shape, source, _ = FACTS[name]
    return shape(raw(spark, sf_dir, source))


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger made of the load ids there are."""
    ids = load_ids(spark, sf_dir)
    status = F.element_at(F.array(*map(F.lit, (2, 3, 4, 5, 99))), (F.col("load_id") % 5 + 1).cast("int"))
    return ids.select(
        "load_id", F.concat(F.lit("report_"), (F.col("load_id") % 500).cast("string"), F.lit(".csv")).alias("source_name"),
        (F.col("load_id") % 7 + 1).cast("int").alias("load_type_id"), status.alias("load_status_id"),
    )


# ---------------------------------------------------------------- vessel reports

_REPORT_COLUMNS = ["load_id", "row_no", *REPORT_TEXT, "work_date", "worktime", *(m[0] for m in MEASURES), "reported", "reported_at"]


@query(f"with c as ({_CLEAN}) select * from c")
def clean_report(spark, sf_dir):
    return report(spark, sf_dir).select(*_REPORT_COLUMNS)


@query("select cast(load_id as bigint) as load_id, row_no, nullif(trim(terminal), '') as terminal, nullif(trim(service), '') as service, nullif(trim(to_port), '') as to_port from gpa_raw")
def clean_text(spark, sf_dir):
    return raw(spark, sf_dir, "gpa_raw").select("load_id", "row_no", *(clean.text(F.col(c)).alias(c) for c in ("terminal", "service", "to_port")))


@query(f"select cast(load_id as bigint) as load_id, row_no, {_REPORTED} as reported_at from gpa_raw")
def parse_reported(spark, sf_dir):
    return raw(spark, sf_dir, "gpa_raw").select("load_id", "row_no", clean.reported_at(F.col("reported")).alias("reported_at"))


_CLOCK = "case row_no % 7 when 0 then '99xx' when 1 then ' ' when 2 then ' 2460' else concat(' ', lpad(cast(row_no % 24 as string), 2, '0'), lpad(cast(load_id % 60 as string), 2, '0')) end"


@query(
    f"with t as (select cast(load_id as bigint) as load_id, row_no, trim({_CLOCK}) as t from gpa_raw), u as (select *, regexp_matches(t, '^([01][0-9]|2[0-3])[0-5][0-9]$') as ok from t)"
    " select load_id, row_no, case when ok then concat(t[1:2], ':', t[3:4]) end as worktime, cast(not ok and t <> '' as int) as bad_cells from u"
)
def parse_worktime(spark, sf_dir):
    """Times of work, some unreadable, which rejects their file."""
    rows = reshape.clean_report(raw(spark, sf_dir, "gpa_raw").withColumn("worktime", F.expr(_CLOCK)))
    return rows.select("load_id", "row_no", "worktime", "bad_cells")


@query(f"with c as ({_CLEAN}) select load_id, row_no, voyage, work_date, worktime, reported_at from c")
def voyage_header(spark, sf_dir):
    return reshape.voyage_header(report(spark, sf_dir))


@query(f"with c as ({_CLEAN}) {_DETAILS}")
def voyage_details_unpivot(spark, sf_dir):
    return reshape.voyage_details(report(spark, sf_dir))


@query(f"with c as ({_CLEAN}) {_FIELDS}")
def voyage_fields_unpivot(spark, sf_dir):
    return reshape.voyage_fields(report(spark, sf_dir))


@query(
    f"with c as ({_CLEAN}), d as ({_DETAILS}) select load_id, row_no, voyage, case equipment_name when '20CH' then 1 when '40CH' then 2 when '45CH' then 3 end as equipment_id,"
    " case direction when 'Import' then 1 else 2 end as direction_id, case mode when 'Vessel' then 1 else 2 end as mode_id, loaded, containers from d"
)
def voyage_details_coded(spark, sf_dir):
    return reshape.coded_details(reshape.voyage_details(report(spark, sf_dir)))


@query(f"with c as ({_CLEAN}) select load_id, row_no, voyage, case when work_date <= cast(reported_at as date) + 1 then 2 when work_date > cast(reported_at as date) + 1 then 3 end as voyage_status_id from c")
def classify_status(spark, sf_dir):
    return report(spark, sf_dir).select("load_id", "row_no", "voyage", clean.classify(F.col("work_date"), F.col("reported_at")).alias("voyage_status_id"))


@query(f"with c as ({_CLEAN}), x as (select *, row_number() over (partition by voyage order by load_id desc, row_no desc) as k from c) select voyage, load_id, work_date, worktime, reported_at from x where k = 1")
def voyage_current(spark, sf_dir):
    return versions.current(report(spark, sf_dir), voyage.VOYAGE).drop("row_no")


@query(f"with {_SEEN} select voyage, load_id, work_date, case when fell_off then coalesce(outcome, 1) else 1 end as voyage_status_id from fell where next_seen is null")
def voyage_status_current(spark, sf_dir):
    return voyage.status_current(report(spark, sf_dir), files(spark, sf_dir))


@query(f"with {_SEEN} select voyage, load_id, next_file as missing_from, outcome as voyage_status_id from fell where fell_off")
def voyage_fallen_off(spark, sf_dir):
    return voyage.fallen_off(report(spark, sf_dir), files(spark, sf_dir))


_TIMELINE = f"""{_SEEN}, t as (select voyage, load_id, 1 as voyage_status_id, load_id as valid_from, case when fell_off and outcome is not null then next_file else next_seen end as valid_to from fell
 union all select voyage, load_id, outcome, next_file, next_seen from fell where fell_off and outcome is not null)"""


@query(f"with {_TIMELINE} select *, valid_to is not null as closed from t")
def voyage_status_history(spark, sf_dir):
    return voyage.status_timeline(report(spark, sf_dir), files(spark, sf_dir))


@query(f"with {_TIMELINE} select voyage, voyage_status_id, valid_from, valid_to from t where valid_from <= 19960615 and (valid_to is null or valid_to > 19960615)")
def voyage_as_of(spark, sf_dir):
    return versions.as_of(voyage.status_timeline(report(spark, sf_dir), files(spark, sf_dir)), 19960615).select("voyage", "voyage_status_id", "valid_from", "valid_to")


_POINTS = "select concat('V', cast((row_no * 7 + load_id) % 120 as string)) as voyage, load_id + row_no % 3 as load_at, row_no as point from gpa_raw"


@query(f"with {_TIMELINE}, p as (select voyage, cast(load_at as bigint) as load_at, point from ({_POINTS})) select p.voyage, load_at, point, voyage_status_id, valid_from, valid_to from p join t on t.voyage = p.voyage and valid_from <= load_at and (valid_to is null or valid_to > load_at)")
def voyage_as_of_points(spark, sf_dir):
    """The status of voyages at as many points as there are report rows, some before a voyage's first report and some of no voyage."""
    points = spark.sql(_POINTS.replace("gpa_raw", "{rows}"), rows=raw(spark, sf_dir, "gpa_raw")).withColumn("load_at", F.col("load_at").cast("long"))
    asked = F.broadcast(points.select("voyage").distinct())  # 120 at most
    # A predicate, as Spark takes it down to the scan; on the trimmed raw cell, as text() would be tried several times a row there. The files are those of all rows.
    rows = reshape.clean_report(raw(spark, sf_dir, "gpa_raw").where(F.btrim("voyage", F.lit(clean.WHITE)).isin(asked)))
    line = voyage.status_timeline(rows, files(spark, sf_dir)).select("voyage", "voyage_status_id", "valid_from", "valid_to")
    return versions.as_of_points(line, points, ["voyage"], 10_000, "load_at").select("voyage", "load_at", "point", "voyage_status_id", "valid_from", "valid_to")


_LATEST = "cur as (select voyage, max(load_id) as load_id from c group by voyage)"


@query(f"with c as ({_CLEAN}), d as ({_DETAILS}), {_LATEST} select d.* from d join cur on d.voyage = cur.voyage and d.load_id = cur.load_id")
def voyage_details_current(spark, sf_dir):
    rows = report(spark, sf_dir)
    return voyage.live_details(reshape.voyage_details(rows), versions.current(rows, voyage.VOYAGE))


@query(f"with c as ({_CLEAN}), d as ({_DETAILS}), {_LATEST} select d.* from d join cur on d.voyage = cur.voyage and d.load_id <> cur.load_id")
def voyage_details_history(spark, sf_dir):
    rows = report(spark, sf_dir)
    return voyage.past_details(reshape.voyage_details(rows), versions.current(rows, voyage.VOYAGE))


@query(f"with c as ({_CLEAN}), d as ({_FIELDS}), x as (select *, row_number() over (partition by voyage, field_type_id order by load_id desc, row_no desc) as k from d) select voyage, field_type_id, field_value from x where k = 1")
def voyage_field_map(spark, sf_dir):
    return voyage.report_fields(report(spark, sf_dir))


@query(
    f"with {_TIMELINE}, l as (select max(load_id) as load_id from c where load_id <= 19960615) select t.voyage, t.load_id from t, l where voyage_status_id = 1 and valid_from < l.load_id"
    " and (valid_to is null or valid_to >= l.load_id) and not exists (select 1 from c where c.load_id = l.load_id and c.voyage = t.voyage)"
)
def tocall_not_in_file(spark, sf_dir):
    rows = report(spark, sf_dir)
    file = load_ids(spark, sf_dir).where("load_id <= 19960615").agg(F.max("load_id")).first()[0]
    return voyage.not_in_file(rows, files(spark, sf_dir), file if file is not None else -1)


@query(f"with c as ({_CLEAN}), {_LATEST} select c.load_id, c.voyage, c.reported_at from c join cur on c.voyage = cur.voyage and c.load_id = cur.load_id where c.reported_at is not null")
def reported_dates(spark, sf_dir):
    rows = report(spark, sf_dir)
    return voyage.reported_dates(rows, versions.current(rows, voyage.VOYAGE).select("load_id", "voyage"))


@query("select * replace (cast(load_id as bigint) as load_id) from gpa_raw where load_id in (19950102, 19960229, 19970704)")
def scan_load(spark, sf_dir):
    """Lands the loads of three months, one partition each, and reads three loads of them back."""
    rows = raw(spark, sf_dir, "gpa_raw").where("load_id div 100 in (199501, 199602, 199707)")
    path = f"{folders.shared_dir(spark)}/landed-{uuid.uuid4().hex}"
    reports.land(rows.repartition("load_id"), path)
    return reports.scan(spark, path, [19950102, 19960229, 19970704]).select(*rows.columns).withColumn("load_id", F.col("load_id").cast("long"))


_ODD = {"vessel": """concat(vessel, ' "', terminal, '" ')""", "service": """case when row_no % 3 = 0 then concat(service, chr(92)) else concat(chr(34), service, chr(34)) end""", "line": "concat(line, chr(10), ',', to_port)"}


@query("select load_id, row_id, trim(vessel) as vessel, trim(line) as line, trim(service) as service, voyage from (select cast(load_id as bigint) as load_id, row_no as row_id, voyage, " + ", ".join(f"{sql} as {c}" for c, sql in _ODD.items()) + " from gpa_raw)")
def csv_quoted(spark, sf_dir):
    """Every report row as CSV with quotes, backslashes, commas and line feeds in its cells, in files as Spark deals them, read back by their records."""
    rows = raw(spark, sf_dir, "gpa_raw").select("load_id", F.col("row_no").alias("row_id"), "voyage", *(F.expr(text).alias(c) for c, text in _ODD.items()))
    folder = f"{folders.shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    rows.write.csv(folder, header=True, quoteAll=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    found = reports.read_files(spark, reports.inputs(spark, folder), ["load_id", "row_id", "vessel", "line", "service", "voyage"])
    return found.select(*(F.col(c).cast("long").alias(c) for c in ("load_id", "row_id")), *(F.trim(c).alias(c) for c in ("vessel", "line", "service", "voyage")))


# ---------------------------------------------------------------- facts


def _listed(columns) -> str:
    return ", ".join(columns)


def _register_fact(name: str) -> None:
    spec, _, _, sql = FACTS[name]
    identity, payload = _listed(spec.identity), _listed(spec.payload)
    ranked = f"with m as ({sql}), x as (select *, row_number() over (partition by {{}} order by load_id desc, row_no desc) as k from m)"

    def mapped(spark, sf_dir):
        return fact(spark, sf_dir, name).drop("bad_cells")

    def current(spark, sf_dir):
        return versions.current(fact(spark, sf_dir, name), spec).drop("row_no")

    def history(spark, sf_dir):
        return versions.history(fact(spark, sf_dir, name), spec)

    collapsed = ranked.format(f"load_id, {identity}") + f", h as (select {identity}, load_id as valid_from, lead(load_id) over (partition by {identity} order by load_id) as valid_to, {payload} from x where k = 1)"
    for kind, f, text in (
        ("mapped", mapped, f"with m as ({sql}) select * from m"),
        ("current", current, ranked.format(identity) + f" select {identity}, load_id, {payload} from x where k = 1"),
        ("history", history, f"{collapsed} select * from h where valid_to is not null"),
    ):
        f.__name__ = f"{name}_{kind}"
        query(text)(f)


for _name in FACTS:
    _register_fact(_name)

_GATE_ID, _GATE_PAY = _listed(GATE.identity), _listed(GATE.payload)


@query(f"with m as ({_GATE}), x as (select *, row_number() over (partition by load_id, {_GATE_ID} order by row_no desc) as k from m) select load_id, {_GATE_ID}, {_GATE_PAY} from x where k = 1")
def gate_activity_collapse(spark, sf_dir):
    return versions.collapse(fact(spark, sf_dir, "gate_activity"), GATE).drop("row_no")


@query(f"with m as ({_GATE}) select load_id, count(*) as n_rows, cast(sum(units) as bigint) as units from m where load_id % 5 <> 0 group by load_id")
def fact_sink(spark, sf_dir):
    """Gate activity landed by load, every second load a second time, as after a retry; read back are the loads that the ledger has not marked as failed."""
    rows = fact(spark, sf_dir, "gate_activity").drop("bad_cells")
    path = f"{folders.shared_dir(spark)}/gates-{uuid.uuid4().hex}"
    reports.land(rows.repartition("load_id"), path)
    reports.land(rows.where("load_id % 2 = 0").repartition("load_id"), path)
    known = rows.select("load_id").distinct().withColumn("load_status_id", F.when(F.col("load_id") % 5 == 0, int(LoadStatus.ERROR)).otherwise(int(LoadStatus.INGESTED)))
    found = reports.landed(spark, path, known).groupBy(F.col("load_id").cast("long").alias("load_id"))
    return found.agg(F.count("*").alias("n_rows"), F.sum("units").alias("units"))


_SPLIT = f"m as ({_GATE}), cut as (select max(load_id) as cut_id from m), old as (select distinct {_GATE_ID} from m, cut where load_id < cut_id), new as (select distinct {_GATE_ID} from m, cut where load_id = cut_id)"
_SAME = " and ".join(f"new.{c} is not distinct from old.{c}" for c in GATE.identity)


@query(f"with {_SPLIT} select case when exists (select 1 from old where {_SAME}) then 'update' else 'insert' end as action, count(*) as n from new group by 1")
def upsert_actions(spark, sf_dir):
    rows = fact(spark, sf_dir, "gate_activity")
    at = rows.agg(F.max("load_id")).first()[0]
    found = versions.actions(versions.current(rows.where(F.col("load_id") < at), GATE), rows.where(F.col("load_id") == at), GATE)
    return found.groupBy("action").agg(F.count("*").alias("n"))


@query(f"with {_SPLIT} select * from old where date in (select date from new)")
def affected_existing(spark, sf_dir):
    rows = fact(spark, sf_dir, "gate_activity")
    at = rows.agg(F.max("load_id")).first()[0]
    return versions.affected(versions.current(rows.where(F.col("load_id") < at), GATE), rows.where(F.col("load_id") == at), GATE).select(*GATE.identity)


@query(f"with m as ({_GATE}), x as (select *, row_number() over (partition by {_GATE_ID} order by load_id desc, row_no desc) as k from m) select {_GATE_ID}, load_id, {_GATE_PAY} from x where k = 1")
def late_load_replay(spark, sf_dir):
    """Even loads first, then odd ones, as if these had come late."""
    rows = fact(spark, sf_dir, "gate_activity")
    first = versions.current(rows.where("load_id % 2 = 0"), GATE)
    return versions.upsert(first, rows.where("load_id % 2 = 1"), GATE).drop("row_no")


def _store(spark: SparkSession, name: str) -> Store:
    return Store(spark, f"{folders.shared_dir(spark)}/{name}-{uuid.uuid4().hex}")


@query(f"with m as ({_GATE}), x as (select *, row_number() over (partition by {_GATE_ID} order by load_id desc, row_no desc) as k from m) select {_GATE_ID}, load_id, {_GATE_PAY} from x where k = 1")
def fact_upsert_stored(spark, sf_dir):
    """Gate activity stored by date in three batches, the second of them late and the third sent twice: each rewrites its own days."""
    rows, store = fact(spark, sf_dir, "gate_activity"), _store(spark, "facts")
    for number, which in enumerate(("load_id % 7 not in (1, 3)", "load_id % 7 = 1", "load_id % 7 = 3", "load_id % 7 = 3")):
        stored.upsert(store, "gate_activity", rows.where(which), GATE, "loads", min(number, 2))
    return stored.stored_facts(store, "gate_activity", rows, GATE).drop("row_no")


@query(f"with m as ({_GATE}), x as (select *, row_number() over (partition by load_id, {_GATE_ID} order by row_no desc) as k from m), h as (select {_GATE_ID}, load_id as valid_from, lead(load_id) over (partition by {_GATE_ID} order by load_id) as valid_to, {_GATE_PAY} from x where k = 1) select * from h where valid_to is not null")
def history_compacted(spark, sf_dir):
    """The history of gate activity from a log of ten batches that was merged in tiers of three."""
    rows, store = fact(spark, sf_dir, "gate_activity"), _store(spark, "versions")
    for number in range(10):
        stored.append_versions(store, "log", rows.where(F.col("row_no") % 10 == number), GATE, "batches", number, 3)
    columns = [*GATE.identity, "load_id", "row_no", *GATE.payload]
    return versions.history(store.read("log", ", ".join(f"{c} {t}" for c, t in rows.select(*columns).dtypes)), GATE)


@query(f"with {_SEEN} select voyage, load_id, work_date, case when fell_off then coalesce(outcome, 1) else 1 end as voyage_status_id from fell where next_seen is null")
def voyage_state_step(spark, sf_dir):
    """Voyages as stored by file in three steps; the files of the second and third come late and split intervals of the first."""
    rows, store = report(spark, sf_dir), _store(spark, "voyages")
    ids = [r["load_id"] for r in load_ids(spark, sf_dir).collect()]  # a number a file
    for number, left in enumerate(((0, 1, 2), (3,), (4,))):
        some = [i for i in ids if i % 5 in left]
        stored.advance_voyages(store, "voyages", rows.where((F.col("load_id") % 5).isin(*left)), some, "files", number)
    return stored.stored_status(store, "voyages")


# ---------------------------------------------------------------- dimension

_NAMES = f"""g as ({_GATE}), s as ({_STREET}), o as ({_ON.format("on_term_raw")}), u as ({_ON.format("oos_raw")}), n as (
 select 8 as field_type_id, trucker_name as value from g union select 1, equip_code from g union select 3, ocean_carrier_name from g union select 5, location_name from g
 union select 5, out_gate_location from s union select 5, in_gate_location from s union select 1, equipment_code from s union select 3, ultimate_user from s
 union select 1, equip_code from o union select 5, location_name from o union select 1, equip_code from u union select 5, location_name from u),
 d as (select field_type_id, value from n where value is not null)"""
_EXTERNAL = """d2 as (select d.*, case field_type_id when 3 then (select min(c_custkey) from customer where c_acctbal > 0 and c_mktsegment = value)
 when 5 then (select min(n_nationkey) from nation where n_regionkey > 0 and n_name = value) when 1 then (select min(p_partkey) from part where p_type = value)
 when 8 then (select min(s_suppkey) from supplier where s_acctbal > 0 and s_name = value) end as external_id from d)"""


def _dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = dims.trimmed_names((raw(spark, sf_dir, source), _named(spec)) for spec, _, source, _ in FACTS.values())
    return dims.find_or_create(None, names)


def _named(spec: FactSpec) -> FactSpec:
    return FactSpec((), (), spec.names)


@query(f"with {_NAMES} select distinct value from d")
def field_values(spark, sf_dir):
    """Texts of the second half of the alphabet come later than the others, and keep to ids of their own."""
    names = dims.trimmed_names((raw(spark, sf_dir, source), _named(spec)) for spec, _, source, _ in FACTS.values())
    first = dims.find_or_create_values(None, names.where("upper(value) < 'N'"))
    found = dims.find_or_create_values(first, names)
    return found.groupBy("id").agg(F.min("value").alias("value")).select("value")


@query(f"with {_NAMES} select field_type_id, value, cast(null as bigint) as external_id, true as notif_flag from d")
def field_type_values(spark, sf_dir):
    return _dimension(spark, sf_dir).drop("id")


@query(f"with {_NAMES} select field_type_id, value, cast(null as bigint) as external_id, true as notif_flag from d")
def dictionary_stored(spark, sf_dir):
    """The names of the four facts found or made in a stored dictionary, fact by fact and the first of them again; every name has one id and every id one name."""
    store = _store(spark, "dictionary")
    parts = [dims.trimmed_names([(raw(spark, sf_dir, source), _named(spec))]) for spec, _, source, _ in FACTS.values()]
    for names in [*parts, parts[0]]:
        dims.find_or_create_stored(store, names)
    found = dims.stored_dimension(store).groupBy("id").agg(F.min(F.struct("field_type_id", "value", "external_id", "notif_flag")).alias("x"), F.count("*").alias("n"))
    return found.where("n = 1").select("x.*")


@query(f"with m as ({_GATE}) select load_id, row_no, trucker_name, equip_code, ocean_carrier_name, location_name, ocean_carrier_name is not null as carrier_known from m")
def gate_activity_resolved(spark, sf_dir):
    """Names to ids and, to show that they are the right ones, back to names."""
    rows = fact(spark, sf_dir, "gate_activity")
    dimension = dims.find_or_create(None, dims.names_of(rows, GATE))
    found = dims.resolve(rows, dimension, GATE)
    back = found.select("load_id", "row_no", *(f"{c}_id" for c, _ in GATE.names))
    for c, kind in GATE.names:
        back = back.join(dims.values_of(dimension, kind).select(F.col("id").alias(f"{c}_id"), F.col("value").alias(c)), f"{c}_id", "left")
    return back.select("load_id", "row_no", *(c for c, _ in GATE.names), F.col("ocean_carrier_name_id").isNotNull().alias("carrier_known"))


@query(f"with {_NAMES} select value from d where field_type_id = 1")
def equipment_dictionary(spark, sf_dir):
    return dims.values_of(_dimension(spark, sf_dir), EQUIPMENT).select("value")


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.resolve_externals(_dimension(spark, sf_dir), {k[0]: table(spark, sf_dir, k[2]) for k in dims.FIELD_TYPES if k[2]})


@query(f"with {_NAMES}, {_EXTERNAL} select field_type_id, value, cast(external_id as bigint) as external_id from d2")
def external_id_resolve(spark, sf_dir):
    return _resolved(spark, sf_dir).select("field_type_id", "value", "external_id")


@query(f"with {_NAMES} select field_type_id, value, field_type_id <> 3 as notif_flag from d")
def notif_flag_cascade(spark, sf_dir):
    _, values = dims.set_notif_flag(dims.field_types(spark), _dimension(spark, sf_dir), OCEAN_CARRIER, False)
    return values.select("field_type_id", "value", "notif_flag")


@query(f"with {_NAMES}, {_EXTERNAL} select field_type_id, value from d2 where external_id is null and field_type_id <> 5")
def unresolved_values(spark, sf_dir):
    _, values = dims.set_notif_flag(dims.field_types(spark), _resolved(spark, sf_dir), LOCATION, False)
    return dims.to_notify(values).select("field_type_id", "value")


# ---------------------------------------------------------------- validation

_SPOILED = f"""c as ({_CLEAN}), v as (select load_id, row_no, case when row_no % 7 = 0 then null else voyage end as voyage, case when row_no % 11 = 0 then null else work_date end as work_date,
 case when row_no % 13 = 0 then null else reported_at end as reported_at, row_no % 17 = 0 and im_full20 <> 0 as odd from c),
 w as (select *, concat('voyage ', coalesce(voyage, concat('in row ', cast(row_no as varchar)))) as name from v),
 p as (select load_id, row_no, 0 as k, concat(name, ' has no number') as problem from w where voyage is null
  union all select load_id, row_no, 1, concat(name, ' has no WORK_DATE') from w where work_date is null
  union all select load_id, row_no, 2, concat(name, ' has no readable REPORTED') from w where reported_at is null
  union all select load_id, row_no, 3, concat(name, ' has equipment of no known type: BOX') from w where odd),
 o as (select *, row_number() over (partition by load_id order by row_no, k) as nth from p),
 r as (select load_id, count(*) as n_problems, concat(string_agg(problem, '; ' order by nth) filter (nth <= 5), case when count(*) > 5 then concat('; and ', cast(count(*) - 5 as varchar), ' more') else '' end) as message
  from o group by load_id)"""


def _boxed(which: str) -> list[tuple]:
    """The measures, the first of them in equipment of no known type in some rows."""
    column, equipment, *rest = MEASURES[0]
    return [(column, F.when(F.expr(which), "BOX").otherwise(equipment), *rest), *MEASURES[1:]]


def _spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports with every seventh voyage blank, and so on, so that there is something to reject."""
    spoil = lambda n, c: F.when(F.col("row_no") % n == 0, None).otherwise(F.col(c))
    return report(spark, sf_dir).withColumns({"voyage": spoil(7, "voyage"), "work_date": spoil(11, "work_date"), "reported_at": spoil(13, "reported_at")})


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.rejected(validate.voyage_problems(_spoiled(spark, sf_dir), measures=_boxed("row_no % 17 = 0")))


@query(f"with {_SPOILED} select * from r")
def validate_voyages(spark, sf_dir):
    return _rejects(spark, sf_dir)


@query(f"with {_SPOILED} select load_id, 99 as load_status_id, message as error_message from r")
def load_errors(spark, sf_dir):
    return _rejects(spark, sf_dir).select("load_id", F.lit(int(LoadStatus.ERROR)).alias("load_status_id"), F.col("message").alias("error_message"))


@query(
    f"with m as ({_GATE}), o as (select distinct load_id, case when row_no % 501 = 0 then cast(3 + row_no % 5 as int) else gate_type_id end as g from m)"
    " select load_id, concat('gate types that do not exist: ', string_agg(cast(g as varchar), ', ' order by g)) as message from o where g not in (1, 2) group by load_id"
)
def validate_gate_types(spark, sf_dir):
    odd = F.when(F.col("row_no") % 501 == 0, (F.col("row_no") % 5 + 3).cast("int")).otherwise(F.col("gate_type_id"))
    return validate.unknown_gate_types(fact(spark, sf_dir, "gate_activity").withColumn("gate_type_id", odd))


# ---------------------------------------------------------------- ledger


@query(f"with {_LEDGER} select * from loads where load_status_id = 4")
def loads_by_status(spark, sf_dir):
    return ledger.by_status(loads(spark, sf_dir), LoadStatus.DETAILS)


@query(f"with {_LEDGER} select * from loads where load_id = (select max(load_id) from loads)")
def load_by_id(spark, sf_dir):
    """The last load there is, by its id."""
    known = loads(spark, sf_dir)
    return ledger.by_id(known, known.agg(F.max("load_id")).first()[0])


@query(f"with {_LEDGER} select * from loads where load_type_id = 4 and load_status_id = 2")
def pending_by_type(spark, sf_dir):
    return ledger.by_type_and_status(loads(spark, sf_dir), LoadType.GATE_ACTIVITY, LoadStatus.INGESTED)


@query(f"with {_LEDGER}, x as (select *, row_number() over (partition by source_name order by load_id) as k from loads where load_status_id <> 99) select source_name, load_id, load_type_id, load_status_id from x where k = 1")
def load_by_name(spark, sf_dir):
    return ledger.earliest_by_name(loads(spark, sf_dir))


_QUEUED = "q as (select *, case load_status_id when 4 then 0 when 3 then 1 when 2 then 2 end as priority from loads where load_status_id in (2, 3, 4))"


@query(f"with {_LEDGER}, {_QUEUED} select * from q")
def pending_queue(spark, sf_dir):
    return ledger.queue(loads(spark, sf_dir))


@query(f"with {_LEDGER}, {_QUEUED}, t as (select * from q order by priority, load_id limit 20) select load_id, load_type_id, load_status_id, case load_type_id when 1 then 'processed' else 'skipped' end as outcome from t")
def process_next(spark, sf_dir):
    return ledger.process_next(loads(spark, sf_dir), 20).select("load_id", "load_type_id", "load_status_id", "outcome")


_ASKED = "a as (select load_id from loads union all select 10 * load_id from loads where load_id % 50 = 0)"


def _routed_sql(load_type: int) -> str:
    done = "load_status_id = 5" if load_type == 1 else "false"
    return (
        f"with {_LEDGER}, {_ASKED}, j as (select a.load_id, l.load_id is not null as there, load_type_id, load_status_id, cast(a.load_id as varchar) as no from a left join loads l on l.load_id = a.load_id)"
        f" select {load_type} as asked_type, load_id, case when not there then 'unknown' when {done} or load_type_id <> {load_type} then 'rejected' else 'processed' end as outcome,"
        f" cast(case when there and not ({done}) and load_type_id <> {load_type} then 99 else load_status_id end as int) as load_status_id,"
        f" case when not there then concat('there is no load ', no) when {done} then concat('load ', no, ' is done already') when load_type_id <> {load_type} then concat('load ', no, ' is not of type {load_type}') end as message from j"
    )


@query(f"select * from ({_routed_sql(1)}) union all select * from ({_routed_sql(4)})")
def pending_routed(spark, sf_dir):
    """Every load, and some that are not there, asked for as a vessel report and as gate activity."""
    known = loads(spark, sf_dir)
    ids = known.select("load_id")
    asked = ids.unionAll(ids.where("load_id % 50 = 0").selectExpr("10 * load_id"))
    parts = [ledger.routed(known, asked, t).select(F.lit(int(t)).alias("asked_type"), "*") for t in (LoadType.VESSEL_REPORT, LoadType.GATE_ACTIVITY)]
    return parts[0].unionByName(parts[1])


@query(f"with {_LEDGER} select count(*) as total, count(*) filter (load_status_id = 99) as failed, count(*) filter (load_status_id <> 99) as imported from loads")
def import_summary(spark, sf_dir):
    return ledger.summary(loads(spark, sf_dir))


# ---------------------------------------------------------------- the processing run

#: Vessel reports, gate activity and street use under one ledger: load ids end in the type. Some loads are done, some failed before.
_RUN_LEDGER = """run_loads as (select load_id, cast(load_id % 10 as int) as load_type_id,
  cast(case when (load_id // 10) % 11 = 0 then 99 when load_id % 10 = 1 then case (load_id // 10) % 4 when 0 then 2 when 1 then 3 when 2 then 4 else 5 end else case (load_id // 10) % 3 when 0 then 4 else 2 end end as int) as load_status_id
  from (select cast(load_id as bigint) * 10 + 1 as load_id from gpa_raw union select cast(load_id as bigint) * 10 + 4 from gate_raw union select cast(load_id as bigint) * 10 + 7 from street_raw))"""
_RUN_SQL = f"""{_SPOILED.replace("row_no % 7 = 0", "row_no % 7 = 0 and load_id % 3 = 0").replace("row_no % 11 = 0", "row_no % 11 = 0 and load_id % 3 = 0").replace("row_no % 13 = 0", "row_no % 13 = 0 and load_id % 3 = 0").replace("row_no % 17 = 0", "row_no % 17 = 0 and load_id % 3 = 0")},
 {_RUN_LEDGER}, m as (select * replace (case when row_no % 1501 = 0 then cast(3 + row_no % 5 as int) else gate_type_id end as gate_type_id) from ({_GATE}) g), s as ({_STREET}), odd_gates as (select distinct load_id * 10 + 4 as load_id, cast(3 + row_no % 5 as int) as g from m where row_no % 1501 = 0),
 bad as (select load_id * 10 + 1 as load_id, message from r
  union all select load_id, concat('gate types that do not exist: ', string_agg(cast(g as varchar), ', ' order by g)) from odd_gates group by load_id),
 taken as (select * from run_loads where load_status_id = 2 or load_type_id = 1 and load_status_id in (3, 4)),
 failed as (select bad.* from bad join taken using (load_id)),
 run_after as (select l.load_id, l.load_type_id, cast(case when f.load_id is not null then 99 when t.load_id is null then l.load_status_id when l.load_type_id = 1 then 5 else 4 end as int) as load_status_id,
  case when f.load_id is not null then 1 when t.load_id is null then 0 when l.load_type_id = 1 then 5 - l.load_status_id else 1 end as n_events
  from run_loads l left join taken t using (load_id) left join failed f using (load_id))"""


def _run_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[int, DataFrame]]:
    """The ledger, and rows by load type: typed ones of vessel reports, with spoiled ones in a third of these, raw ones of the others."""
    by = lambda rows, t: rows.withColumn("load_id", F.col("load_id") * 10 + t)
    reports_raw = by(raw(spark, sf_dir, "gpa_raw"), 1)
    spoil = lambda n, c: F.when(F.expr(f"{_THIRD} % {n} = 0"), None).otherwise(F.col(c))
    gates = by(raw(spark, sf_dir, "gate_raw"), 4).withColumn("gate_type", F.when(F.col("row_no") % 1501 == 0, (F.col("row_no") % 5 + 3).cast("string")).otherwise(F.col("gate_type")))
    streets = by(raw(spark, sf_dir, "street_raw"), 7)
    day_ids = [load_ids(spark, sf_dir).selectExpr("load_id * 10 + 1 as load_id"), gates.select("load_id").distinct(), streets.select("load_id").distinct()]
    ids = day_ids[0].unionAll(day_ids[1]).unionAll(day_ids[2])
    status = F.expr(
        "case when (load_id div 10) % 11 = 0 then 99 when load_id % 10 = 1 then case (load_id div 10) % 4 when 0 then 2 when 1 then 3 when 2 then 4 else 5 end else case (load_id div 10) % 3 when 0 then 4 else 2 end end"
    )
    folders.shared_dir(spark)
    known = ids.select("load_id", (F.col("load_id") % 10).cast("int").alias("load_type_id"), status.cast("int").alias("load_status_id")).checkpoint()  # a row a load
    spoiled = reports_raw.withColumns({"voyage": spoil(7, "voyage"), "work_date": spoil(11, "work_date"), "reported": spoil(13, "reported")})
    return known, {LoadType.VESSEL_REPORT: reshape.clean_report(spoiled), LoadType.GATE_ACTIVITY: gates, LoadType.STREET_USE_DAYS: streets}


_THIRD = "(load_id - 1) div 10 % 3 = 0 and row_no"


def _run(spark: SparkSession, sf_dir: str):
    """The processing run over vessel reports, gate activity and street use, with spoiled rows in a third of the reports."""
    known, rows = _run_inputs(spark, sf_dir)
    typed = rows.pop(LoadType.VESSEL_REPORT)
    voyage_run = process.run_voyages(known, typed, measures=_boxed(f"{_THIRD} % 17 = 0"))
    run, states = sources.process_loads(voyage_run.loads, rows)
    states["voyages"] = process.voyages(voyage_run, typed)
    return known, process.Processed(run.loads, voyage_run.events.unionByName(run.events), voyage_run.errors.unionByName(run.errors), voyage_run.good.unionByName(run.good)), states


@query(f"with {_RUN_SQL} select a.load_id, a.load_type_id, a.load_status_id, cast(a.n_events as bigint) as n_events, f.message from run_after a left join failed f using (load_id)")
def process_run(spark, sf_dir):
    """The ledger after a processing run, with the steps taken and why a load failed."""
    _, run, _ = _run(spark, sf_dir)
    counted = run.events.groupBy("load_id").agg(F.count("*").alias("n_events"))
    return run.loads.join(counted, "load_id", "left").join(run.errors, "load_id", "left").select("load_id", "load_type_id", "load_status_id", F.coalesce("n_events", F.lit(0)).alias("n_events"), "message")


@query(f"with {_RUN_SQL} select load_id, load_status_id, cast(n_events + 1 as bigint) as n_steps from run_after")
def ledger_status(spark, sf_dir):
    """The status of each load by its events: what it was before the run, and the run's own."""
    known, run, _ = _run(spark, sf_dir)
    return ledger.current_status(ledger.opening(known).unionByName(run.events))


@query(
    f"with {_RUN_SQL}, ok as (select load_id // 10 as load_id from run_after where load_type_id = 1 and load_status_id = 5),"
    " c2 as (select v.* from v join ok using (load_id)), f as (select load_id, lead(load_id) over (order by load_id) as next_file from ok),"
    " seen as (select voyage, load_id, work_date, reported_at, next_file, lead(load_id) over (partition by voyage order by load_id) as next_seen from c2 join f using (load_id) where voyage is not null)"
    " select voyage, load_id * 10 + 1 as load_id, work_date, case when next_file is null then 1 when work_date <= cast(reported_at as date) + 1 then 2 when work_date > cast(reported_at as date) + 1 then 3 else 1 end as voyage_status_id"
    " from seen where next_seen is null"
)
def process_run_voyages(spark, sf_dir):
    """Voyages after the run: rejected reports neither update a voyage nor make one fall off."""
    return _run(spark, sf_dir)[2]["voyages"]


@query(
    f"with {_RUN_SQL}, x as (select m.*, row_number() over (partition by {_GATE_ID} order by m.load_id desc, row_no desc) as k from m join run_after a on a.load_id = m.load_id * 10 + 4 where a.load_status_id = 4)"
    f" select {_GATE_ID}, load_id * 10 + 4 as load_id, {_GATE_PAY} from x where k = 1"
)
def process_run_gates(spark, sf_dir):
    """Gate activity after the run, without the loads that name a gate type which does not exist."""
    return _run(spark, sf_dir)[2]["gate_activity"].drop("row_no")


_STORED_SQL = _RUN_SQL.replace("row_no % 17 = 0 and load_id % 3 = 0 and im_full20 <> 0", "false")


@query(f"with {_STORED_SQL} select load_id, load_status_id, cast(n_events + 1 as bigint) as n_steps from run_after")
def ledger_status_stored(spark, sf_dir):
    """The run over pending loads that stores facts, voyages, ledger and errors in one commit, sent twice; the ledger's steps as they are read back."""
    known, typed = _run_inputs(spark, sf_dir)
    store, errors = _store(spark, "run"), _store(spark, "errors")
    stored.register(store, known.withColumn("source_name", F.col("load_id").cast("string")))
    facts = {LoadType.GATE_ACTIVITY: (GATE, "gate_activity"), LoadType.STREET_USE_DAYS: (STREET_USE, "street_use_days")}
    inputs = {t: (sources.source(t).shape(rows), *facts[t]) if t in facts else (typed[t], None, "voyages") for t, rows in typed.items()}
    for _ in range(2):
        stored.process_stored(store, errors, inputs, number=1)
    return ledger.current_status(stored.steps_of(store))


@query(
    f"with {_LEDGER}, f as (select concat('report_', cast(cast(load_id as bigint) % 1000 as varchar), '.csv') as source_name, count(*) as n_rows,"
    " cast(count(*) filter (row_no % 97 = 0) as bigint) as n_bad from gpa_raw group by 1)"
    " select source_name, n_rows, n_bad, case when source_name in (select source_name from loads where load_status_id <> 99) then 'skipped' when n_bad > 0 then 'failed' else 'ingested' end as outcome from f"
)
def ingest_outcome(spark, sf_dir):
    """Files named by the last three digits of their loads; every 97th row has a cell that is no number."""
    rows = raw(spark, sf_dir, "gpa_raw").withColumn("im_full20", F.when(F.col("row_no") % 97 == 0, "x").otherwise(F.col("im_full20")))
    name = F.concat(F.lit("report_"), (F.col("load_id") % 1000).cast("string"), F.lit(".csv"))
    files = reshape.clean_report(rows).groupBy(name.alias("source_name")).agg(F.count("*").alias("n_rows"), F.sum(F.least("bad_cells", F.lit(1))).cast("long").alias("n_bad"))
    return ledger.ingest_outcome(files, loads(spark, sf_dir))


@query(" union all ".join(f"select '{n}' as table_name, count(*) as n from {n}" for n in BRIDGES))
def table_counts(spark, sf_dir):
    out = None
    for name in BRIDGES:
        part = raw(spark, sf_dir, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("select n_nationkey, case when n_regionkey < 3 then n_name else upper(concat(n_name, ' *')) end as n_name from nation")
def seed_merge(spark, sf_dir):
    """Nations of the first regions are there; a seed of all nations, with other names, adds the rest and changes none."""
    nations = table(spark, sf_dir, "nation")
    existing = nations.where("n_regionkey < 3").select("n_nationkey", "n_name")
    return ledger.merge_seed(existing, nations.select("n_nationkey", F.upper(F.concat("n_name", F.lit(" *"))).alias("n_name")), "n_nationkey")
