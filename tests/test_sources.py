import csv
import random
import re

import pytest

from portflow.operators import versions, voyage
from portflow.sources import records, reports
from portflow.specs import FactSpec
from portflow.streaming import watch

HEAD = "TERMINAL,WORK_DATE,VESSEL,VOYAGE,LINE,SERVICE,FROM PORT,TO PORT,WORKTIME,IM_FULL20,IM_FULL40,REPORTED"
LOADS = "load_id long, source_name string, load_type_id int, load_status_id int"


def put(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")


def test_folder(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    put(src, "a1.csv", f"﻿{HEAD}\n T1 ,20250704,S,V1,L,SV,O,D,1700,5,,07032025\n T1 ,20250704,S,V2,L,SV,O,D,1700,1,2,07032025\n")
    put(src, "a2.CSV", "VOYAGE,REPORTED,EXTRA,WORK_DATE\nV1,071020261348,x,20260711\n")
    put(src, "a3.csv", f"{HEAD}\nT1,20250704,S,V1,L,SV,O,D,1700,five,,07032025\nT1,20250704,S,V3,L,SV,O,D,1700,5,,07032025\n")
    put(src, "a4.csv", f"{HEAD}\nT1,20250704,S,V9,L,SV,O,D,1700,5,,07032025\n")
    put(src, "a5.csv", f"{HEAD}\n")
    put(src, "~$a6.csv", "x\n")
    put(src, "note.txt", "x\n")
    loads = spark.createDataFrame([(7, "a4.csv", 1, 2), (6, "a1.csv", 1, 99)], LOADS)
    raw = str(tmp_path / "raw")
    outcome, new, errors = reports.ingest_folder(spark, str(src), raw, loads)
    assert {r.source_name: (r.outcome, r.n_rows) for r in outcome.collect()} == {
        "a1.csv": ("ingested", 2), "a2.CSV": ("ingested", 1), "a3.csv": ("failed", 2), "a4.csv": ("skipped", 0), "a5.csv": ("ingested", 0)
    }
    assert {r.source_name: r.load_status_id for r in new.collect()} == {"a1.csv": 2, "a2.CSV": 2, "a3.csv": 99, "a5.csv": 2}
    assert [r.error_message for r in errors.collect()] == ["a3.csv: 1 unreadable rows"]
    ids = {r.source_name: r.load_id for r in new.collect()}
    assert ids["a1.csv"] < ids["a2.CSV"] and min(ids.values()) == 8
    got = {(r.load_id, r.row_no, r.voyage, r.from_port, r.im_full20) for r in spark.read.parquet(raw).collect()}
    assert got == {(ids["a1.csv"], 1, "V1", "O", 5), (ids["a1.csv"], 2, "V2", "O", 1), (ids["a2.CSV"], 1, "V1", None, None)}
    assert reports.scan(spark, raw, [ids["a2.CSV"]]).count() == 1
    assert reports.landed(spark, raw, new.where("source_name = 'a1.csv'")).count() == 2
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    reports.land(spark.read.parquet(raw).where(f"load_id = {ids['a2.CSV']}").checkpoint(), raw)  # again: nothing doubles
    assert spark.read.parquet(raw).count() == 3


def test_odd_files(spark, tmp_path):
    """No bytes, hidden names, one tilde, a time that is none, a quoted header."""
    src = tmp_path / "in"
    src.mkdir()
    put(src, "zero.csv", "")
    put(src, "_u.csv", "VOYAGE\nV5\n")
    put(src, ".h.csv", f"{HEAD}\n")
    put(src, "~x.csv", "VOYAGE,REPORTED,WORK_DATE\nV1,071020261348,20260711\n")
    put(src, "time.csv", "VOYAGE,WORKTIME\nV2,99xx\n")
    put(src, "with space % + ü.csv", "VOYAGE\nV4\n")
    put(src, "quoted.csv", '"VOYAGE","A, B","FROM PORT"\nV3,"x, y",O\n')
    outcome, new, errors = reports.ingest_folder(spark, str(src), str(tmp_path / "raw"), spark.createDataFrame([], LOADS))
    assert {r.source_name: (r.outcome, r.n_rows, r.n_bad) for r in outcome.collect()} == {
        "zero.csv": ("ingested", 0, 0), "_u.csv": ("ingested", 1, 0), ".h.csv": ("ingested", 0, 0), "~x.csv": ("ingested", 1, 0), "time.csv": ("failed", 1, 1), "quoted.csv": ("ingested", 1, 0), "with space % + ü.csv": ("ingested", 1, 0)
    }
    assert {r.error_message for r in errors.collect()} == {"time.csv: 1 unreadable rows"}
    assert {(r.voyage, r.from_port) for r in spark.read.parquet(str(tmp_path / "raw")).collect()} == {("V1", None), ("V3", "O"), ("V4", None), ("V5", None)}
    assert new.count() == 7


def brute_rows(files, columns):
    """(source_name, row_no and columns) as csv.DictReader reads the files."""
    out = []
    for name, path in files.items():
        with open(path, newline="", encoding="utf-8-sig") as f:
            for n, row in enumerate(csv.DictReader(f), 1):
                by = {records.normal(k): v for k, v in row.items() if k is not None}
                out.append((name, n, *(by.get(c) for c in columns)))
    return out


def same_rows(got, want):
    """Line feeds that end a cell may differ where quotes are never closed; every cell is trimmed afterwards."""
    key = lambda rows: sorted(str([v.rstrip("\r\n") if isinstance(v, str) else v for v in r]) for r in rows)
    assert key(got) == key(want)


@pytest.mark.parametrize("split", ["128m", "64b", "200b"])
def test_records_equal_dict_reader(spark, tmp_path, split):
    """Random cells, quotes, line ends and headers; splits far smaller than records."""
    rng, columns, files = random.Random(split), ["a", "b", "c"], {}
    bits = ['"', '""', "a", "b ", ",", ",", "\n", "\r\n", "\r", "\\", '\\"', 'x"y', "é", '""""']
    for k in range(40):
        head = rng.choice(["a,b,c", "\ufeffa,b,c", '\ufeff"a","b",c', 'c,x,"a\nz",b', "a,a,b", ""])
        name = f"{rng.choice(['', '_', '.'])}f{k}.csv"
        path = tmp_path / name
        path.write_text(head + rng.choice(["\n", "\r\n"]) + "".join(rng.choices(bits, k=rng.randint(0, 120))), encoding="utf-8", newline="")
        files[name] = str(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        got = [tuple(r) for r in reports.read_files(spark, files, columns).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    same_rows(got, brute_rows(files, columns))


def test_long_rows_and_cells(spark, tmp_path):
    put(tmp_path, "big.csv", "a,b,c\n" + "," * 300_000 + '\n"' + '""' * 300_000 + '",x,y\n"' + "p," * 300_000 + 'q",r\n')
    got = reports.read_files(spark, {"big.csv": str(tmp_path / "big.csv")}, ["a", "b", "c"]).orderBy("row_no").collect()
    assert [(len(r.a), r.b, r.c) for r in got] == [(0, "", ""), (300_000, "x", "y"), (600_001, "r", None)]


def test_quoted_cells_land_as_they_are(spark, tmp_path):
    """The cells that were misread: doubled quotes, a backslash before a quote, a line feed within quotes."""
    src = tmp_path / "in"
    src.mkdir()
    put(src, "q.csv", f'{HEAD}\nT1,20250704,"SHIP ""A"" x",V1,L,"S\\",F,T,0800,1,2,01012026\nT1,20250704,"SHIP\nTWO",V2,L,S,F,T,0800,1,2,01012026\n')
    reports.ingest_folder(spark, str(src), str(tmp_path / "raw"), spark.createDataFrame([], LOADS))
    got = spark.read.parquet(str(tmp_path / "raw")).orderBy("row_no").collect()
    assert [(r.row_no, r.vessel, r.voyage, r.service, r.from_port, r.reported) for r in got] == [(1, 'SHIP "A" x', "V1", "S\\", "F", "01012026"), (2, "SHIP\nTWO", "V2", "S", "F", "01012026")]


def test_a_landing_that_was_cut_off(spark, tmp_path):
    """What it wrote aside or put in place is not in the ledger, and the next try takes its place."""
    src, raw = tmp_path / "in", tmp_path / "raw"
    src.mkdir()
    put(src, "a.csv", "VOYAGE\nV1\n")
    (raw / "_aside-x/load=1").mkdir(parents=True)
    spark.createDataFrame([("half",)], "voyage string").write.parquet(str(raw / "load_id=1"))
    outcome, _, _ = reports.ingest_folder(spark, str(src), str(raw), spark.createDataFrame([], LOADS))
    assert [r.load_id for r in outcome.collect()] == [1] and [r.voyage for r in spark.read.parquet(str(raw)).collect()] == ["V1"]


def test_scan_prunes_partitions(spark, tmp_path):
    raw = str(tmp_path / "raw")
    reports.land(spark.createDataFrame([(k, "x") for k in range(5)], "load_id long, voyage string"), raw)
    rows = reports.scan(spark, raw, [3])
    plan = rows._jdf.queryExecution().toString()
    assert rows.count() == 1 and "PartitionFilters: [isnotnull(load_id" in plan


def test_stream_equals_batch(spark, tmp_path):
    """Reordered headers, bad files, late files, files sent again: as in one batch over all of them."""
    src, home = tmp_path / "in", str(tmp_path / "home")
    src.mkdir()
    head = ",".join(reports.COLUMNS)

    def row(v, order=reports.COLUMNS, **more):
        cells = {"voyage": v, "work_date": "20250704", "reported": "07032025"} | more
        return ",".join(cells.get(c, "") for c in order)

    def run():
        watch.watch(spark, str(src), home, str(tmp_path / "cp")).awaitTermination()

    put(src, "r3.csv", f"{head}\n{row('A')}\n")
    run()
    back = reports.COLUMNS[::-1]
    put(src, "r1.csv", f"{','.join(back).upper()}\n{row('A', back)}\n{row('B', back)}\n")  # late, in another order
    put(src, "r2.csv", f"{head}\n{row('C')}\n{row('D', im_full20='five')}\n")  # bad
    put(src, "r4.csv", f"{head}\n")
    put(src, "none.csv", f"{head}\n")
    put(src, "x3.csv", f"{head}\n{row('E')}\n")  # claims a number that is taken
    run()
    loads = watch.logged(spark, f"{home}/loads", watch.LOADS)
    assert {(r.source_name, r.load_id, r.load_status_id) for r in loads.collect()} == {("r3.csv", 3, 2), ("r1.csv", 1, 2), ("r2.csv", 2, 99), ("r4.csv", 4, 2), ("none.csv", None, 99), ("x3.csv", 3, 99)}
    assert {r.error_message for r in watch.logged(spark, f"{home}/errors", watch.ERRORS).collect()} == {"r2.csv: 1 unreadable rows", "none.csv: no number in the name", "x3.csv: its number belongs to another file"}
    rows = reports.landed(spark, f"{home}/raw", loads)
    assert {(r.load_id, r.row_no, r.voyage) for r in rows.select("load_id", "row_no", "voyage").collect()} == {(3, 1, "A"), (1, 1, "A"), (1, 2, "B")}
    good = loads.where("load_status_id = 2").select("load_id")
    got = {r.voyage: r.voyage_status_id for r in voyage.status_current(rows, voyage.follow(good)).collect()}
    assert got == {"A": 2, "B": 2}  # r4.csv is a file without rows
    # in one batch
    outcome, new, _ = reports.ingest_files(spark, reports.inputs(spark, str(src)), str(tmp_path / "batch"), spark.createDataFrame([], LOADS), ids=reports.numbers_in_names)
    assert {r.source_name for r in outcome.where("outcome = 'ingested'").collect()} == {"r1.csv", "r4.csv"}  # r3 and x3 claim one number at once
    # the second batch again, as after a driver lost before its checkpoint
    before = sorted(map(str, loads.drop("date_loaded").collect())), rows.count()
    for f in (tmp_path / "cp/commits").glob("*1*"):
        f.unlink()
    run()
    loads = watch.logged(spark, f"{home}/loads", watch.LOADS)
    assert (sorted(map(str, loads.drop("date_loaded").collect())), reports.landed(spark, f"{home}/raw", loads).count()) == before


def test_stream_of_facts(spark, tmp_path):
    spec = FactSpec(("date", "name"), ("units",))
    schema = "load_id long, row_no long, date string, name string, units int"
    spark.createDataFrame([(2, 1, "d", None, 2)], schema).write.parquet(str(tmp_path / "in/a"))
    stream = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in/*"))
    watch.keep_versions(stream(), spec, str(tmp_path / "s"), str(tmp_path / "cp")).awaitTermination()
    spark.createDataFrame([(1, 1, "d", None, 1), (1, 2, "d", "x", 5)], schema).write.parquet(str(tmp_path / "in/b"))
    watch.keep_versions(stream(), spec, str(tmp_path / "s"), str(tmp_path / "cp")).awaitTermination()
    log = watch.logged(spark, str(tmp_path / "s"), schema)
    assert {(r.name, r.units) for r in versions.current(log, spec).collect()} == {(None, 2), ("x", 5)}
    assert [(r.valid_from, r.valid_to, r.units) for r in versions.history(log, spec).collect()] == [(1, 2, 1)]


def test_lines_stay_in_their_task(spark, tmp_path):
    """Nothing is sorted or shuffled to put records together, but for the parts of those that go on over the end of a split."""
    put(tmp_path, "f.csv", "a,b\n" + '"xx\ny",z\n' * 50)
    files = {"f.csv": str(tmp_path / "f.csv")}
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    whole = reports.read_files(spark, files, ["a", "b"])
    assert not any(s in plan(whole) for s in ("Window", "Sort", "Exchange hashpartitioning"))
    want = [("f.csv", n, "xx\ny", "z") for n in range(1, 51)]
    assert sorted(map(tuple, whole.collect())) == want
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        split = reports.read_files(spark, files, ["a", "b"])
        assert re.findall(r"Window|Exchange hashpartitioning\(\w+", plan(split)) == ["Exchange hashpartitioning(file"]
        assert sorted(map(tuple, split.collect())) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
