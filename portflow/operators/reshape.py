"""Projections and unpivots: raw rows to typed rows, wide rows to long ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.functions import clean
from portflow.specs import DIRECTIONS, EQUIPMENT_TYPES, FIELDS, MEASURES, MODES, REPORT_TEXT

_LONG_KEYS = ["load_id", "row_no", "voyage"]


def clean_report(raw: DataFrame) -> DataFrame:
    """Typed vessel-report rows; `bad_cells` counts cells that are neither blank nor readable."""
    numbers = [m[0] for m in MEASURES]
    # one step after the other, so that no cell is trimmed or read twice
    cells = raw.withColumns({c: clean.text(F.col(c)) for c in (*REPORT_TEXT, "work_date", "worktime", *numbers, "reported")})
    read = {"work_date": clean.day, "worktime": clean.clock} | dict.fromkeys(numbers, clean.whole)
    typed = cells.withColumns({f"{c}_read": f(F.col(c)) for c, f in read.items()})
    bad = [(F.col(c).isNotNull() & F.col(f"{c}_read").isNull()).cast("int") for c in read]
    return typed.select(
        "load_id", "row_no", *REPORT_TEXT, F.col("work_date_read").alias("work_date"), F.col("worktime_read").alias("worktime"), *(F.col(f"{c}_read").alias(c) for c in numbers),
        "reported", clean.reported_at(F.col("reported")).alias("reported_at"), sum(bad, F.lit(0)).alias("bad_cells"),
    )


def voyage_header(report: DataFrame) -> DataFrame:
    return report.select("load_id", "row_no", "voyage", "work_date", "worktime", "reported_at")


def voyage_details(report: DataFrame) -> DataFrame:
    """One row per measure that is neither NULL nor zero."""
    long = report.unpivot(_LONG_KEYS, [m[0] for m in MEASURES], "measure", "containers").where("containers <> 0")
    spec = report.sparkSession.createDataFrame(MEASURES, "measure string, equipment_name string, direction string, mode string, loaded int")
    found = long.join(F.broadcast(spec), "measure")  # nine rows
    return found.select(*_LONG_KEYS, "equipment_name", "direction", "mode", F.col("loaded").cast("boolean").alias("loaded"), "containers")


def voyage_fields(report: DataFrame) -> DataFrame:
    """One row per descriptive field that is not blank."""
    long = report.unpivot(_LONG_KEYS, [f[0] for f in FIELDS], "field", "field_value").where("field_value is not null")
    spec = report.sparkSession.createDataFrame(FIELDS, "field string, field_type_id int")
    return long.join(F.broadcast(spec), "field").select(*_LONG_KEYS, "field_type_id", "field_value")  # six rows


def coded_details(details: DataFrame) -> DataFrame:
    """Names to ids. A missing equipment name stays NULL; rows of unknown modes or directions are those of unknown_codes()."""
    spark = details.sparkSession
    mode = spark.createDataFrame(list(MODES.items()), "mode string, mode_id int")
    direction = spark.createDataFrame(list(DIRECTIONS.items()), "direction string, direction_id int")
    equipment = spark.createDataFrame(list(EQUIPMENT_TYPES.items()), "equipment_name string, equipment_id int")
    out = details.join(F.broadcast(mode), "mode").join(F.broadcast(direction), "direction").join(F.broadcast(equipment), "equipment_name", "left")
    return out.select(*_LONG_KEYS, "equipment_id", "direction_id", "mode_id", "loaded", "containers")


def unknown_codes(details: DataFrame) -> DataFrame:
    """(load_id, row_no, voyage, name): modes and directions that have no id, which coded_details() can't keep."""
    name = F.explode(F.array_compact(F.array(*(F.when(~F.coalesce(F.col(c).isin(list(known)), F.lit(False)), F.concat(F.lit(f"{c} "), F.coalesce(c, F.lit("NULL")))) for c, known in (("mode", MODES), ("direction", DIRECTIONS))))))
    return details.select(*_LONG_KEYS, name.alias("name"))


def gate_activity(raw: DataFrame) -> DataFrame:
    """`bad_cells`: a gate type that is neither blank nor a number."""
    return raw.select(
        "load_id", "row_no", "date", *(clean.text(F.col(c)).alias(c) for c in ("trucker_name", "equip_code")), "equip_length", "length_match_id",
        clean.text(F.col("ocean_carrier_name")).alias("ocean_carrier_name"), clean.whole(F.col("gate_type")).alias("gate_type_id"),
        "bare_chassis_flag", "container_loaded_flag", clean.text(F.col("location_name")).alias("location_name"), "units", "transactions",
        clean.bad_whole(F.col("gate_type")).cast("int").alias("bad_cells"),
    )


def counted_equipment(raw: DataFrame) -> DataFrame:
    """On-terminal and out-of-service rows, which have one shape."""
    return raw.select("load_id", "row_no", "date", *(clean.text(F.col(c)).alias(c) for c in ("equip_code", "location_name")), "units")


def street_use(raw: DataFrame) -> DataFrame:
    names = {c: clean.text(F.col(c)) for c in ("out_gate_location", "in_gate_location", "equipment_code", "ultimate_user")}
    return raw.withColumns(names).select(
        "load_id", "row_no", "out_gate_date", "out_gate_location", "in_gate_date", "in_gate_location", "equipment_code", "ultimate_user", "count_of_records"
    )
