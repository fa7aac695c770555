"""What is kept between runs: commits that are cut off or meet, facts by date, voyages by file, tiers, the stored run."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from portflow.operators import dims, ledger, stored, versions, voyage
from portflow.sources import store as stores
from portflow.sources.folders import create_if_absent
from portflow.specs import GATE, FactSpec, LoadType
from tests.test_edges import files, report
from tests.test_property import fold

SPEC = FactSpec(("date", "name"), ("units",))
ROWS = "load_id long, row_no long, date date, name string, units int"
NUMBERS = "k int"


@pytest.fixture
def store(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    return stores.Store(spark, str(tmp_path / "store"))


def day(n):
    return dt.date(2026, 1, 1) + dt.timedelta(days=n)


def rows(spark, *some):
    return spark.createDataFrame([(load, row, None if d is None else day(d), name, units) for load, row, d, name, units in some], ROWS)


def numbers(spark, *ks):
    return spark.createDataFrame([(k,) for k in ks], NUMBERS)


def held(store, table="t"):
    return sorted(r.k for r in store.read(table, NUMBERS).collect())


def test_a_name_is_given_once(spark, tmp_path):
    path = str(tmp_path / "a/b.json")
    assert create_if_absent(spark, path, "one") and not create_if_absent(spark, path, "two")
    assert (tmp_path / "a/b.json").read_text() == "one" and [f.name for f in (tmp_path / "a").iterdir()] == ["b.json"]


def test_cut_off_commits_are_not_seen(spark, store, tmp_path):
    store.publish([store.stage("t", numbers(spark, 1))], "s", 1)
    store.stage("t", numbers(spark, 2))  # written aside, and then the driver was lost
    log = tmp_path / "store/log"
    (log / ".half.tmp").write_text('{"version": 2, "tab')
    (tmp_path / "store/data/w=half/_temporary/0").mkdir(parents=True)
    assert held(store) == [1]
    assert store.publish([store.stage("t", numbers(spark, 2))], "s", 2)  # the same batch again
    assert not store.publish([store.stage("t", numbers(spark, 2))], "s", 2)
    assert held(store) == [1, 2]
    assert store.vacuum(1) == 3 and held(store) == [1, 2]  # two left-overs and the refused third


def test_two_writers_of_one_batch(spark, store):
    mine, theirs = store.stage("t", numbers(spark, 1)), store.stage("t", numbers(spark, 1))
    assert [store.publish([theirs], "s", 1), store.publish([mine], "s", 1)] == [True, False]
    assert held(store) == [1]
    assert store.publish([theirs], "s", 1)  # an answer that was lost: it is in, once
    assert held(store) == [1]


def test_writers_of_one_version(spark, store, monkeypatch):
    """Another writer publishes between this one's look and its own publishing."""
    real, raced = stores.create_if_absent, []

    def slow(*a):
        if not raced:
            raced.append(1)
            assert stores.Store(spark, store.path).publish([store.stage("t", numbers(spark, 7))], "s", 7)
        return real(*a)

    monkeypatch.setattr(stores, "create_if_absent", slow)
    assert store.publish([store.stage("t", numbers(spark, 8))], "s", 8)
    assert held(store) == [7, 8] and store.manifest().version == 2 and store.manifest().batches == {"s": [[7, 8]]}


def test_two_folds_at_once(spark, store):
    for k in range(4):
        store.publish([store.stage("t", numbers(spark, k))])
    some = [e["folder"] for e in store.manifest().entries("t")]
    folds = [store.stage("t", store.read("t", NUMBERS), replaces=some, level=1) for _ in range(2)]
    assert [store.publish([f]) for f in folds] == [True, False]
    assert held(store) == [0, 1, 2, 3]


def test_upsert_reads_and_writes_its_days_only(spark, store):
    first = rows(spark, *[(1, k, k % 6, f"n{k % 4}", k) for k in range(48)])
    assert stored.upsert(store, "f", first, SPEC, "s", 1)
    before = store.manifest().owners("f")
    batch = rows(spark, (2, 0, 2, "n0", 100), (2, 1, 2, "new", 5), (2, 2, 9, None, 6), (2, 3, None, "n0", 7))
    m = store.manifest()
    known = store.read("f", ROWS, m, ["2026-01-03", "2026-01-10", stored.NO_DAY])
    assert {f.split("key=")[1][:10] for f in known.inputFiles()} == {"2026-01-03"}
    assert "InMemoryFileIndex(1 paths)" in known._jdf.queryExecution().toString()  # of six
    assert stored.upsert(store, "f", batch, SPEC, "s", 2)
    after = store.manifest().owners("f")
    assert {k for k in after if after[k] != before.get(k)} == {"2026-01-03", "2026-01-10", stored.NO_DAY}
    written = after["2026-01-03"][0]
    assert {f.split("key=")[1].split("/")[0] for f in store.read("f", ROWS).inputFiles() if written in f} == {"2026-01-03", "2026-01-10", stored.NO_DAY}
    want = versions.current(first.unionByName(batch), SPEC)
    got = stored.stored_facts(store, "f", first, SPEC).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert not stored.upsert(store, "f", batch, SPEC, "s", 2)


def test_upserts_in_any_order(spark, store):
    rng, batches = random.Random(5), []
    for load in range(6):
        batches.append(rows(spark, *[(load, k, rng.choice([0, 1, 2, None]), rng.choice(["a", "b", None]), rng.randrange(100)) for k in range(5)]))
    every = batches[0]
    for b in batches[1:]:
        every = every.unionByName(b)
    rng.shuffle(batches)
    for b in batches:
        stored.upsert(store, "f", b, SPEC)
    want = versions.current(every, SPEC)
    assert sorted(map(str, stored.stored_facts(store, "f", every, SPEC).select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_a_day_that_another_writer_took_is_merged_again(spark, store):
    a, b = rows(spark, (1, 1, 0, "a", 1)), rows(spark, (2, 1, 0, "b", 2))
    m = store.manifest()
    mine = stored.stage_upsert(store, m, "f", a, SPEC)
    assert stored.upsert(store, "f", b, SPEC)
    assert not store.publish([mine])  # it would lose b
    assert stored.upsert(store, "f", a, SPEC)
    assert {r.name for r in store.read("f", ROWS).collect()} == {"a", "b"}


def test_voyages_in_any_order_of_files(spark, store):
    """Steps of several files, late ones between, files without rows: as one fold over all."""
    rng = random.Random(11)
    history = {load: {v for v in "ABCDEF" if rng.random() < 0.5} if rng.random() < 0.8 else set() for load in range(1, 11)}
    made, dates = {}, {}
    for load, voyages in history.items():
        for k, v in enumerate(sorted(voyages)):
            gap = rng.choice([0, 1, 2, None])
            dates[v, load] = None if gap is None else 2 if gap <= 1 else 3
            on = day(load)
            made.setdefault(load, []).append((load, k, v, None if gap is None else str(on + dt.timedelta(days=gap)), f"{on}T05:00:00"))
    order = list(history)
    rng.shuffle(order)
    for n, some in enumerate((order[:3], order[3:4], order[4:8], order[8:])):
        assert stored.advance_voyages(store, "v", report(spark, [r for f in some for r in made.get(f, [])]), some, "files", n, 3)
    assert stored.advance_voyages(store, "v", report(spark, made.get(order[0], [])), order[:1], "files", 9, 3)  # one that is in already
    got = {r.voyage: r.voyage_status_id for r in stored.stored_status(store, "v").collect()}
    assert got == fold(history, dates)
    every = report(spark, [r for f in made.values() for r in f])
    want = {(r.voyage, r.load_id, r.missing_from, r.voyage_status_id) for r in voyage.fallen_off(every, files(spark, history)).collect()}
    fell = store.read("v", stored.APPEARANCES).where("fell_off")
    assert {(r.voyage, r.load_id, r.next_file, r.status) for r in fell.collect()} == want
    assert {r.voyage for r in stored.still_to_call(store, "v", 3).collect()} == history[10]


def test_a_late_file_touches_its_neighbours_only(spark, store):
    line = lambda f, *vs: [(f, k, v, "2026-01-01", "2026-01-01T00:00:00") for k, v in enumerate(vs)]
    for f in (10, 20, 30, 40):
        stored.advance_voyages(store, "v", report(spark, line(f, "A", "B")), [f], span=1)
    before = store.manifest().owners("v")
    stored.advance_voyages(store, "v", report(spark, line(25, "A")), [25], span=1)
    after = store.manifest().owners("v")
    assert {k for k in after if after[k] != before.get(k)} == {"20", "25"}
    assert {(r.voyage, r.load_id) for r in store.read("v", stored.APPEARANCES).where("fell_off").collect()} == {("B", 20)}


def test_tiers_bound_the_folders(spark, store):
    every = None
    for n in range(18):
        batch = rows(spark, (n, 1, n % 3, "a", n), (n, 2, n % 3, None, n))
        every = batch if every is None else every.unionByName(batch)
        assert stored.append_versions(store, "log", batch, SPEC, "s", n, 3)
        assert len(store.manifest().entries("log")) <= 2 * 3
    assert not stored.append_versions(store, "log", rows(spark, (17, 1, 2, "a", 17)), SPEC, "s", 17, 3)
    log = store.read("log", ROWS)
    assert sorted(map(str, versions.history(log, SPEC).collect())) == sorted(map(str, versions.history(every, SPEC).collect()))


def run_inputs(spark):
    loads = spark.createDataFrame([(1, "r1", 1, 2), (2, "r2", 1, 2), (3, "r3", 1, 2), (4, "g4", 4, 2), (5, "g5", 4, 2), (6, "g6", 4, 4)], stored.LOADS)
    vessel = report(spark, [(1, 1, "A", "2026-07-04", "2026-07-03T00:00:00"), (1, 2, "B", "2026-07-04", "2026-07-03T00:00:00"), (2, 1, "A", None, "2026-07-03T00:00:00"), (3, 1, "A", "2026-07-08", "2026-07-07T00:00:00")])
    measures = ("terminal", "vessel", "line", "service", "from_port", "to_port")
    numbers = ("im_full20", "im_full40", "im_full45", "im_mt", "ex_full20", "ex_full40", "ex_mt", "rail_im20", "rail_im40")
    vessel = vessel.withColumns({c: F.lit("x") for c in measures} | {c: F.lit(1) for c in numbers})
    gate = lambda load, kind: (load, 1, day(load), "t", "e", 40, 1, "c", kind, True, False, "l", 2, 1)
    names = ("load_id long, row_no long, date date, trucker_name string, equip_code string, equip_length int, length_match_id int, ocean_carrier_name string, gate_type_id int,"
             " bare_chassis_flag boolean, container_loaded_flag boolean, location_name string, units int, transactions int")  # fmt: skip
    gates = spark.createDataFrame([gate(4, 1), gate(5, 9), gate(6, 1)], names)
    return loads, {LoadType.VESSEL_REPORT: (vessel, None, "voyages"), LoadType.GATE_ACTIVITY: (gates, GATE, "gates")}


def test_the_run_stores_what_it_decides(spark, store, tmp_path):
    errors = stores.Store(spark, str(tmp_path / "errors"))
    loads, sources = run_inputs(spark)
    assert stored.register(store, loads) and not stored.register(store, loads)
    assert stored.process_stored(store, errors, sources, number=1)
    assert {r.load_id: r.load_status_id for r in stored.ledger_of(store).collect()} == {1: 5, 2: 99, 3: 5, 4: 4, 5: 99, 6: 4}
    assert {r.load_id for r in errors.read("errors", stored.ERRORS).collect()} == {2, 5}
    assert {(r.voyage, r.load_id, r.voyage_status_id) for r in stored.stored_status(store, "voyages").collect()} == {("A", 3, 1), ("B", 1, 2)}
    assert {r.load_id for r in store.read("gates", ", ".join(f"{c} {t}" for c, t in sources[LoadType.GATE_ACTIVITY][0].select(*GATE.identity, "load_id").dtypes)).collect()} == {4}
    assert stored.live_details(store, "voyages").count() == 18 and stored.field_map(store).count() == 12
    events = stored.steps_of(store)
    assert {r.load_id: (r.load_status_id, r.n_steps) for r in ledger.current_status(events).collect()} == {1: (5, 4), 2: (99, 2), 3: (5, 4), 4: (4, 2), 5: (99, 2), 6: (4, 1)}
    assert not stored.process_stored(store, errors, sources, number=1)
    before = store.manifest().owners("gates")
    assert stored.process_stored(store, errors, sources, number=2)  # nothing is pending: nothing changes
    assert store.manifest().owners("gates") == before and events.count() == stored.steps_of(store).count()


def test_errors_stay_when_the_commit_fails(spark, store, tmp_path, monkeypatch):
    errors = stores.Store(spark, str(tmp_path / "errors"))
    loads, sources = run_inputs(spark)
    stored.register(store, loads)
    real = store.stage
    monkeypatch.setattr(store, "stage", lambda table, *a, **k: 1 / 0 if table == "events" else real(table, *a, **k))
    with pytest.raises(ZeroDivisionError):
        stored.process_stored(store, errors, sources, number=1)
    assert {r.load_id for r in errors.read("errors", stored.ERRORS).collect()} == {2, 5}
    assert {r.load_status_id for r in stored.ledger_of(store).where("load_id < 6").collect()} == {2} and not store.manifest().owners("voyages")
    monkeypatch.undo()
    assert stored.process_stored(store, errors, sources, number=1)
    assert errors.read("errors", stored.ERRORS).count() == 2 and stored.stored_status(store, "voyages").count() == 2


# ---------------------------------------------------------------- dictionary and points in time

NAMES = "field_type_id int, value string"


def test_dictionary_of_two_runs_at_once(spark, store, monkeypatch):
    """The other run adds names of its own, some of them the same, between this run's look and its publishing."""
    names = lambda *vs: spark.createDataFrame([(1, v) for v in vs], NAMES)
    assert dims.find_or_create_stored(store, names("a", "b", None, "a"), 4) == 2
    before = {r.value: r.id for r in dims.stored_dimension(store).collect()}
    real, raced = dims.reserve, []

    def reserve(s, n):
        if not raced:
            raced.append(1)
            dims.find_or_create_stored(stores.Store(spark, store.path), names("c", "d", "e", "f", "g"), 4)
        return real(s, n)

    monkeypatch.setattr(dims, "reserve", reserve)
    assert dims.find_or_create_stored(store, names("a", "c", "d", "x", "y", "z"), 4) == 3
    got = [(r.value, r.id) for r in dims.stored_dimension(store).collect()]
    assert sorted(v for v, _ in got) == list("abcdefgxyz") and len({i for _, i in got}) == 10 and before.items() <= dict(got).items()
    assert dims.find_or_create_stored(store, names("a", "z"), 4) == 0


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_points_in_time_equal_brute_force(spark, width):
    rng, line = random.Random(width), []
    for who in ("A", "B", None):
        at = rng.randrange(5)
        for _ in range(12):
            to = at + rng.randint(1, 6)
            line.append((who, at, to if rng.random() < 0.9 else to - 1 if to - 1 > at else to, rng.randrange(100)))
            at = to
        line.append((who, at, None, 7))
    points = [(rng.choice(["A", "B", None, "C"]), rng.randrange(-3, 70), k) for k in range(300)]
    timeline = spark.createDataFrame(line, "who string, valid_from long, valid_to long, v int")
    got = versions.as_of_points(timeline, spark.createDataFrame(points, "who string, at long, k int"), ["who"], width)
    want = [(w, at, k, f, t, v) for w, at, k in points for x, f, t, v in line if x == w and f <= at and (t is None or t > at)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert not {"CartesianProduct", "BroadcastNestedLoopJoin"} & set(got._jdf.queryExecution().executedPlan().toString().split())


def test_times_asked_for_by_many_points_are_run_through_once(spark, windowed):
    timeline = spark.createDataFrame([("A", 1, 4, 1), ("A", 4, None, 2), (None, 2, 6, 3)], "who string, valid_from long, valid_to long, v int")
    points = [(("A", None, "C")[k % 3], k % 8 if k % 5 else None, k % 1500) for k in range(3000)]
    got = versions.as_of_points(timeline, spark.createDataFrame(points, "who string, at long, k int"), ["who"], 3)
    seen = windowed(got)
    assert len(seen) >= 2 and max(seen) < 100
    line = [("A", 1, 4, 1), ("A", 4, None, 2), (None, 2, 6, 3)]
    want = [(w, at, k, f, t, v) for w, at, k in points if at is not None for x, f, t, v in line if x == w and f <= at and (t is None or t > at)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_a_step_goes_through_its_rows_once(spark, store, monkeypatch):
    """Whether a voyage is in the next file is told by where it is seen next; rows are not made again to be held against themselves."""
    plans, stage = [], stores.Store.stage
    monkeypatch.setattr(stores.Store, "stage", lambda self, table, rows, *a, **k: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or stage(self, table, rows, *a, **k))
    line = lambda f, *vs: [(f, k, v, "2026-01-01", "2026-01-01T00:00:00") for k, v in enumerate(vs)]
    stored.advance_voyages(store, "v", report(spark, line(1, "A", "B") + line(2, "B")), [1, 2])
    assert plans[0].count("Aggregate [voyage") == 1
    assert {(r.voyage, r.load_id, r.fell_off) for r in store.read("v", stored.APPEARANCES).collect()} == {("A", 1, True), ("B", 1, False), ("B", 2, False)}


def test_rows_aside_are_written_once_and_go(spark, tmp_path):
    """What a step reads several times is made once, is in no manifest, and is removed, also if the step fails."""
    store, made = stores.Store(spark, str(tmp_path)), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.range(100).mapInArrow(counted, "id long")
    with pytest.raises(ValueError), store.aside(rows) as some:
        assert some.count() == 100 and some.agg({"id": "sum"}).first()[0] == 4950 and made.value == 100
        raise ValueError
    assert not list((tmp_path / "data").iterdir()) and store.manifest().version == 0
