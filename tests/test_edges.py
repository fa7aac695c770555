"""The edge semantics, one by one, on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from portflow.functions import clean
from portflow.operators import dims, ledger, reshape, validate, versions, voyage
from portflow.sources.registry import errors_of, process_loads, source
from portflow.specs import GATE, MEASURES, REPORT_TEXT, STREET_USE, FactSpec

REPORT = "load_id long, row_no long, voyage string, work_date date, worktime string, reported_at timestamp"
SPEC = FactSpec(("date", "name"), ("units",))
ROWS = "load_id long, row_no long, date string, name string, units int"


def day(s):
    return dt.date.fromisoformat(s)


def report(spark, rows):
    return spark.createDataFrame([(a, b, v, w and day(w), None, r and dt.datetime.fromisoformat(r)) for a, b, v, w, r in rows], REPORT)


def files(spark, ids):
    return voyage.follow(spark.createDataFrame([(i,) for i in ids], "load_id long"))


def status(df):
    return {r.voyage: r.voyage_status_id for r in df.collect()}


@pytest.mark.parametrize(
    ("text", "want"),
    [("11152026", dt.datetime(2026, 11, 15)), ("12252026", dt.datetime(2026, 12, 25)), ("071020261348", dt.datetime(2026, 7, 10, 13, 48)),
     ("2025918", None), ("900", None), (None, None), ("", None), ("   ", None), ("BADDATE", None)],
)
def test_reported(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(clean.reported_at(F.col("t"))).first()[0] == want


def test_clean_cells(spark):
    df = spark.createDataFrame([("\t a b ", " 12 ", "1700", "20260131"), ("  ", "12.0", "2500", "20261301"), (None, "", None, None)], "t string, n string, c string, d string")
    got = df.select(clean.text(F.col("t")), clean.whole(F.col("n")), clean.bad_whole(F.col("n")), clean.clock(F.col("c")), clean.day(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [("a b", 12, False, "17:00", day("2026-01-31")), (None, None, True, None, None), (None, None, False, None, None)]


def test_called_canceled_boundary(spark):
    df = report(spark, [(1, 1, "A", "2026-07-04", "2026-07-03T13:00:00"), (1, 2, "B", "2026-07-04", "2026-07-02T13:00:00"), (1, 3, "C", None, "2026-07-02T13:00:00")])
    assert status(voyage.status_current(df, files(spark, [1, 2]))) == {"A": 2, "B": 3, "C": 1}  # an empty second file drops all; unknown dates change nothing
    assert status(voyage.status_current(df, files(spark, [1]))) == {"A": 1, "B": 1, "C": 1}


def test_reappearance(spark):
    df = report(spark, [(1, 1, "A", "2026-07-04", "2026-07-03T00:00:00"), (3, 1, "A", "2026-07-09", "2026-07-08T00:00:00")])
    line = sorted((r.valid_from, r.voyage_status_id, r.valid_to) for r in voyage.status_timeline(df, files(spark, [1, 2, 3])).collect())
    assert line == [(1, 1, 2), (2, 2, 3), (3, 1, None)]
    assert {r.valid_from for r in versions.as_of(voyage.status_timeline(df, files(spark, [1, 2, 3])), 2).collect()} == {2}


def test_not_in_file_of_empty_file(spark):
    df = report(spark, [(1, 1, "A", "2026-07-04", "2026-07-03T00:00:00"), (1, 2, "B", "2026-07-04", "2026-07-03T00:00:00")])
    assert {r.voyage for r in voyage.not_in_file(df, files(spark, [1, 2]), 2).collect()} == {"A", "B"}


def test_unpivot_skips_null_and_zero(spark):
    columns = ["load_id", "row_no", *REPORT_TEXT, *(m[0] for m in MEASURES)]
    values = {"load_id": 1, "row_no": 1, "voyage": "V", "vessel": "S", "im_full20": 5, "im_full40": 0, "ex_mt": -2, "rail_im20": 7}
    schema = ", ".join(f"{c} {'long' if c in ('load_id', 'row_no') else 'string' if c in REPORT_TEXT else 'int'}" for c in columns)
    df = spark.createDataFrame([tuple(values.get(c) for c in columns)], schema)
    got = {(r.equipment_name, r.direction, r["mode"], r.loaded, r.containers) for r in reshape.voyage_details(df).collect()}
    assert got == {("20CH", "Import", "Vessel", True, 5), (None, "Export", "Vessel", False, -2), ("20CH", "Import", "Rail", False, 7)}
    assert {r.equipment_id for r in reshape.coded_details(reshape.voyage_details(df)).collect()} == {1, None}
    assert [(r.field_type_id, r.field_value) for r in reshape.voyage_fields(df).collect()] == [(2, "S")]


def test_blank_keeps_field(spark):
    df = spark.createDataFrame([(1, 1, "V", 4, "AE7"), (2, 1, "W", 4, "X")], "load_id long, row_no long, voyage string, field_type_id int, field_value string")
    assert {(r.voyage, r.field_value) for r in voyage.field_map(df).collect()} == {("V", "AE7"), ("W", "X")}


def test_upsert_nulls_are_equal_and_last_wins(spark):
    rows = [(1, 1, "d", None, 5), (1, 2, "d", None, 6), (2, 1, "d", None, 7), (1, 3, None, "x", 1)]
    df = spark.createDataFrame(rows, ROWS)
    assert {(r.name, r.units) for r in versions.current(df, SPEC).collect()} == {(None, 7), ("x", 1)}
    assert [(r.valid_from, r.valid_to, r.units) for r in versions.history(df, SPEC).collect()] == [(1, 2, 6)]
    kinds = {r.name: r.action for r in versions.actions(versions.current(df.where("load_id = 1"), SPEC), df.where("load_id = 2"), SPEC).collect()}
    assert kinds == {None: "update"}


def test_late_load(spark):
    df = spark.createDataFrame([(1, 1, "d", "x", 1), (2, 1, "d", "x", 2), (3, 1, "d", "x", 3)], ROWS)
    late = versions.upsert(versions.current(df.where("load_id <> 2"), SPEC), df.where("load_id = 2"), SPEC)
    assert [r.units for r in late.collect()] == [3]


def test_empty_facts(spark):
    df = spark.createDataFrame([], ROWS)
    assert versions.current(df, SPEC).count() == versions.history(df, SPEC).count() == 0


def test_dimension_ids_are_stable(spark):
    names = spark.createDataFrame([(5, "a"), (5, "b"), (8, "a")], "field_type_id int, value string")
    first = dims.find_or_create(None, names)
    ids = {(r.field_type_id, r.value): r.id for r in first.collect()}
    assert sorted(ids.values()) == [1, 2, 3]
    second = dims.find_or_create(first, names.unionAll(spark.createDataFrame([(5, "c")], names.schema)))
    after = {(r.field_type_id, r.value): r.id for r in second.collect()}
    assert {k: after[k] for k in ids} == ids and after[5, "c"] == 4


def test_external_ids(spark):
    dimension = dims.find_or_create(None, spark.createDataFrame([(5, "X"), (5, "x"), (2, "X")], "field_type_id int, value string"))
    ext = spark.createDataFrame([("X", 9, 1), ("X", 7, 1), ("x", 3, 0)], "n_name string, n_nationkey int, n_regionkey int")
    got = {(r.field_type_id, r.value): (r.external_id, r.n_matches) for r in dims.resolve_external(dimension, 5, ext).collect()}
    assert got == {(5, "X"): (7, 2), (5, "x"): (None, 0), (2, "X"): (None, None)}
    with pytest.raises(ValueError, match="n_name"):
        dims.resolve_external(dimension, 5, ext.drop("n_name"))


def test_validation(spark):
    df = report(spark, [(1, 0, None, "2026-01-01", None), (2, 0, "A", "2026-01-01", "2026-01-01T00:00:00"), (3, 0, "B", "2026-01-01", "2026-01-01T00:00:00"), (3, 1, "B", "2026-01-01", "2026-01-01T00:00:00")])
    details = spark.createDataFrame([(2, 0, "A", "BOX")], "load_id long, row_no long, voyage string, equipment_name string").withColumns({"mode": F.lit("Vessel"), "direction": F.lit("Import")})
    got = {r.load_id: r.message for r in validate.rejected(validate.voyage_problems(df, details)).collect()}
    assert got == {1: "voyage in row 0 has no number; voyage in row 0 has no readable REPORTED", 2: "voyage A has equipment of no known type: BOX", 3: "voyage B comes more than once"}
    gates = spark.createDataFrame([(1, 9), (1, 3), (1, 1), (2, None)], "load_id long, gate_type_id int")
    assert [tuple(r) for r in validate.unknown_gate_types(gates).collect()] == [(1, "gate types that do not exist: 3, 9")]


def test_a_message_tells_the_first_problems_and_how_many_more(spark):
    df = report(spark, [(1, k, None, "2026-01-01", "2026-01-01T00:00:00") for k in range(40)])
    details = reshape.voyage_details(df.select("*", *(F.lit(0).alias(m[0]) for m in MEASURES)))
    got = validate.rejected(validate.voyage_problems(df, details)).collect()
    assert [(r.n_problems, r.message) for r in got] == [(40, "; ".join(f"voyage in row {k} has no number" for k in range(5)) + "; and 35 more")]
    assert validate.voyage_problems(df, details).count() == 40


def test_unknown_codes_are_told(spark):
    df = report(spark, [(1, 1, "A", "2026-01-01", "2026-01-01T00:00:00")])
    details = spark.createDataFrame([(1, 1, "A", None, "Import", "Barge", True, 5), (1, 1, "A", None, None, "Rail", True, 5)], "load_id long, row_no long, voyage string, equipment_name string, direction string, mode string, loaded boolean, containers int")
    assert {r.name for r in reshape.unknown_codes(details).collect()} == {"mode Barge", "direction NULL"}
    assert validate.rejected(validate.voyage_problems(df, details)).first().message == "voyage A has an unknown direction NULL; voyage A has an unknown mode Barge"


LOADS = "load_id long, source_name string, load_type_id int, load_status_id int"


def test_ledger(spark):
    loads = spark.createDataFrame([(1, "a", 1, 99), (2, "a", 1, 2), (3, "b", 4, 4), (4, "c", 1, 3), (5, "d", 1, None), (6, "e", 1, 5)], LOADS)
    assert [r.load_id for r in ledger.queue(loads).collect()] == [3, 4, 2]
    assert {r.load_id: r.outcome for r in ledger.process_next(loads, 2).collect()} == {3: "skipped", 4: "processed"}
    assert {r.source_name: r.load_id for r in ledger.earliest_by_name(loads).collect()} == {"a": 2, "b": 3, "c": 4, "e": 6}
    asked = spark.createDataFrame([(k,) for k in (1, 2, 3, 6, 77)], "load_id long")
    got = {r.load_id: (r.outcome, r.load_status_id, r.message) for r in ledger.routed(loads, asked).collect()}
    assert got == {1: ("processed", 99, None), 2: ("processed", 2, None), 3: ("rejected", 99, "load 3 is not of type 1"), 6: ("rejected", 5, "load 6 is done already"), 77: ("unknown", None, "there is no load 77")}


def test_steps(spark):
    """From where a load stopped; other types from ingested to details; failures to failed."""
    loads = spark.createDataFrame([(1, 1, 2), (2, 1, 3), (3, 1, 4), (4, 4, 2), (5, 7, 2), (6, 1, 2)], "load_id long, load_type_id int, load_status_id int")
    rejects = spark.createDataFrame([(5, "x"), (6, "y")], "load_id long, message string")
    events = ledger.steps(loads, rejects)
    path = {}
    for r in events.orderBy("load_id", "seq").collect():
        path.setdefault(r.load_id, []).append(r.status)
    assert path == {1: [3, 4, 5], 2: [4, 5], 3: [5], 4: [4], 5: [99], 6: [99]}
    assert {r.load_id: r.load_status_id for r in ledger.current_status(ledger.opening(loads).unionByName(events)).collect()} == {1: 5, 2: 5, 3: 5, 4: 4, 5: 99, 6: 99}


def raw_report(spark, rows):
    """rows: (load_id, row_no, voyage, work_date, reported, im_full20)"""
    columns = ["load_id", "row_no", *source(1).columns]
    schema = "load_id long, row_no long, " + ", ".join(f"{c} string" for c in source(1).columns)
    cells = [dict(zip(("load_id", "row_no", "voyage", "work_date", "reported", "im_full20"), r, strict=True)) for r in rows]
    return spark.createDataFrame([tuple(c.get(x) for x in columns) for c in cells], schema)


def test_a_rejected_file_changes_nothing(spark):
    """The middle one of three files is bad: it updates no voyage, and drops none from the report."""
    rows = [(1, 1, "A", "20260704", "07032026", "5"), (1, 2, "B", "20260704", "07032026", "2"), (2, 1, "A", "20260709", "07082026", "7"), (2, 2, None, "20260709", "07082026", None), (3, 1, "A", "20260711", "07102026", "9")]
    loads = spark.createDataFrame([(k, 1, 2) for k in (1, 2, 3)] + [(4, 2, 2)], "load_id long, load_type_id int, load_status_id int")
    run, states = process_loads(loads, {1: raw_report(spark, rows)})
    assert {r.load_id: r.load_status_id for r in run.loads.collect()} == {1: 5, 2: 99, 3: 5, 4: 2}
    assert [tuple(r) for r in run.errors.collect()] == [(2, "voyage in row 2 has no number")]
    assert {r.voyage: (r.load_id, r.voyage_status_id) for r in states["voyages"].collect()} == {"A": (3, 1), "B": (1, 2)}
    line = voyage.status_timeline(reshape.clean_report(raw_report(spark, rows)).join(run.good, "load_id"), voyage.follow(run.good))
    assert {(r.voyage, r.valid_from, r.valid_to) for r in line.where("voyage = 'B'").collect()} == {("B", 1, 3), ("B", 3, None)}
    assert {(r.voyage, r.containers) for r in states["details"].collect()} == {("A", 9), ("B", 2)}
    assert [r.error_message for r in errors_of(run).collect()] == ["voyage in row 2 has no number"]
    again, states = process_loads(run.loads, {1: raw_report(spark, rows)})  # nothing is pending any more
    assert again.events.count() == again.errors.count() == 0
    assert {r.voyage: (r.load_id, r.voyage_status_id) for r in states["voyages"].collect()} == {"A": (3, 1), "B": (1, 2)}


def test_an_empty_file_drops_voyages_and_a_bad_one_does_not(spark):
    rows = [(1, 1, "A", "20260704", "07032026", "5"), (2, 1, "A", "2026-07", "07082026", None)]
    loads = spark.createDataFrame([(k, 1, 2) for k in (1, 2)], "load_id long, load_type_id int, load_status_id int")
    assert process_loads(loads, {1: raw_report(spark, rows)})[1]["voyages"].first().voyage_status_id == 1
    assert process_loads(loads, {1: raw_report(spark, rows[:1])})[1]["voyages"].first().voyage_status_id == 2


def test_gates_of_unknown_type_reject_their_load(spark):
    columns = "load_id long, row_no long, date string, trucker_name string, equip_code string, equip_length int, length_match_id int, ocean_carrier_name string, gate_type string, bare_chassis_flag boolean, container_loaded_flag boolean, location_name string, units int, transactions int"
    row = lambda load, n, gate: (load, n, "d", " T ", "E", 40, 1, None, gate, True, True, "L", n, 1)
    raw = spark.createDataFrame([row(1, 1, "1"), row(1, 2, " 1 "), row(2, 3, "9"), row(2, 4, "1"), row(3, 5, "in"), row(4, 6, " ")], columns)
    loads = spark.createDataFrame([(k, 4, 2) for k in (1, 2, 3, 4)], "load_id long, load_type_id int, load_status_id int")
    run, states = process_loads(loads, {4: raw})
    assert {r.load_id: r.load_status_id for r in run.loads.collect()} == {1: 4, 2: 99, 3: 99, 4: 4}
    assert {r.load_id: r.message for r in run.errors.collect()} == {2: "gate types that do not exist: 9", 3: "1 rows have unreadable cells"}
    assert {(r.load_id, r.gate_type_id, r.units) for r in states["gate_activity"].collect()} == {(1, 1, 2), (4, None, 6)}


def test_unknown_source():
    with pytest.raises(KeyError, match="load type 2"):
        source(2)


def test_value_ids_are_stable(spark):
    names = spark.createDataFrame([(5, "a"), (1, "a"), (5, "b")], "field_type_id int, value string")
    first = dims.find_or_create_values(None, names)
    ids = {r.value: r.id for r in first.collect()}
    after = {r.value: r.id for r in dims.find_or_create_values(first, names.unionAll(spark.createDataFrame([(5, "c")], names.schema))).collect()}
    assert sorted(ids.values()) == [1, 2] and after == ids | {"c": 3}


def test_specs_agree():
    assert {c for c, _ in GATE.names} <= set(GATE.identity) and {c for c, _ in STREET_USE.names} <= set(STREET_USE.identity)


def test_each_cell_is_trimmed_once(spark):
    """A cell that is read, and held against what was read, is trimmed for both; and no pattern is tried on what is too short for it."""
    raw = spark.createDataFrame([], ", ".join(f"{c} string" for c in (*REPORT_TEXT, "work_date", "worktime", *(m[0] for m in MEASURES), "reported"))).selectExpr("1L as load_id", "1L as row_no", "*")
    plan = reshape.clean_report(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan
    white = "".join(map(chr, (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
    assert white == clean.WHITE and all(c.isspace() for c in white)
    df = spark.createDataFrame([(f"{white}a{white}b{white}",), (white,), ("​﻿᠎",)], "t string")  # the last are no white space
    assert [r[0] for r in df.select(clean.text(F.col("t"))).collect()] == [f"a{white}b", None, "​﻿᠎"]


def test_report_fields_equal_the_map_of_unpivoted_fields(spark):
    """Blank cells keep the value before, voyages without a number are one group, and nothing is unpivoted before it is grouped."""
    raw = [(load, row, v, vessel, port) for load, row, v, vessel, port in [(1, 1, "A", "X", "P"), (2, 1, "A", None, "Q"), (2, 2, "A", "Y", None), (3, 1, None, "Z", None), (1, 2, None, "W", "R"), (4, 1, "B", None, None)]]
    df = spark.createDataFrame(raw, "load_id long, row_no long, voyage string, vessel string, to_port string")
    df = df.withColumns({c: F.lit(None).cast("string") for c in ("line", "service", "terminal", "from_port")})
    got = voyage.report_fields(df)
    want = voyage.field_map(reshape.voyage_fields(df)).collect()
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want} and len(want) == 4
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate") and "Expand" not in plan  # the plan is written from its end


def test_names_are_made_once(spark):
    """Distinct before they are trimmed, and kept, so that numbering them twice does not read the facts again."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([("  a",), ("a",), ("b ",), (" ",), (None,)], "name string").coalesce(1).mapInArrow(counted, "name string")
    names = dims.trimmed_names([(rows, FactSpec((), (), (("name", 5),)))])
    first = dims.find_or_create_values(None, names.where("value = 'a'"))
    assert {r.value for r in dims.find_or_create_values(first, names).collect()} == {"a", "b"}
    assert seen.value == 5


def test_measures_are_judged_in_their_rows(spark):
    """Codes that are unknown in some rows give the problems that their unpivoted details give; the report is read once."""
    n = [m[0] for m in MEASURES]
    rows = [(1, r, f"V{r}", dt.date(2025, 7, 4), dt.datetime(2025, 7, 3), *((r + i) % 3 for i in range(len(n)))) for r in range(1, 30)]
    df = spark.createDataFrame(rows, "load_id long, row_no long, voyage string, work_date date, reported_at timestamp, " + ", ".join(f"{c} int" for c in n))
    boxed, barge = F.when(F.expr("row_no % 4 = 0"), "BOX").otherwise("20CH"), F.when(F.expr("row_no % 5 = 0"), "Barge").when(F.expr("row_no % 5 <> 1"), "Rail")
    details = reshape.voyage_details(df)
    first = (F.col("equipment_name") == "20CH") & (F.col("mode") == "Vessel") & (F.col("direction") == "Import")
    last = (F.col("equipment_name") == "40CH") & (F.col("mode") == "Rail")
    details = details.withColumns({"equipment_name": F.when(first, boxed).otherwise(F.col("equipment_name")), "mode": F.when(last, barge).otherwise(F.col("mode"))})
    measures = [(n[0], boxed, *MEASURES[0][2:]), *MEASURES[1:-1], (n[-1], "40CH", "Import", barge, 0)]
    found = validate.voyage_problems(df, measures=measures)
    assert sorted(found.collect()) == sorted(validate.voyage_problems(df, details).collect()) and found.count() > 10
    assert validate.voyage_problems(df).count() == 0  # the measures as they are have codes that are known
    odd = [("im_mt", "TANK", "Sideways", None, 0)]
    assert {r.problem.partition(" has ")[2] for r in validate.voyage_problems(df, measures=odd).collect()} == {"equipment of no known type: TANK", "an unknown direction Sideways", "an unknown mode NULL"}


def test_the_current_status_needs_no_window(spark):
    """A voyage's last appearance is combined before the shuffle; it is the last of appearances(), also where a file holds a voyage twice or a file does not count."""
    day = dt.date(2025, 7, 4)
    rows = [(1, 1, "A", day, 3), (1, 2, "A", day, 1), (2, 1, "B", day, 2), (3, 1, "B", None, 2), (2, 2, "C", day, 3), (4, 1, "C", day, 3), (9, 1, "D", day, 3), (3, 2, None, day, 3), (4, 2, "E", day, None)]
    df = spark.createDataFrame([(load, r, v, d, None, None if n is None else dt.datetime(2025, 7, n)) for load, r, v, d, n in rows], "load_id long, row_no long, voyage string, work_date date, worktime string, reported_at timestamp")
    known = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, None)], "load_id long, next_file long")
    got = voyage.status_current(df, known)
    last = voyage.appearances(df, known).where("next_seen is null").selectExpr("voyage", "load_id", "work_date", "coalesce(status, 1) as voyage_status_id")
    assert sorted(map(str, got.collect())) == sorted(map(str, last.collect())) and {r.voyage for r in got.collect()} == set("ABCE")
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
