"""Whole-file validation: one bad row rejects its load."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portflow.specs import DIRECTIONS, EQUIPMENT_TYPES, GATE_TYPES, MEASURES, MODES

#: Problems that a message tells; the frame of problems has them all.
TOLD = 5


def measure_problems(measures: Iterable[tuple]) -> list[tuple[int, Column, list]]:
    """(k, whether a row has it, what is said) of each measure (column, equipment, direction, mode, ...) whose codes may be unknown. Codes are text or
    columns; text that is known can't be wrong in any row, so that it is not looked at."""
    found = []
    for column, equipment, direction, mode, *_ in measures:
        there = F.col(column) != 0
        if isinstance(equipment, Column) or not (equipment is None or equipment in EQUIPMENT_TYPES):
            name = equipment if isinstance(equipment, Column) else F.lit(equipment)
            found.append((3, there & name.isNotNull() & ~name.isin(list(EQUIPMENT_TYPES)), [" has equipment of no known type: ", name]))
        for kind, code, known in (("mode", mode, MODES), ("direction", direction, DIRECTIONS)):
            if isinstance(code, Column) or code not in known:
                name = code if isinstance(code, Column) else F.lit(code).cast("string")
                found.append((5, there & ~F.coalesce(name.isin(list(known)), F.lit(False)), [f" has an unknown {kind} ", F.coalesce(name, F.lit("NULL"))]))
    return found


def voyage_problems(report: DataFrame, details: DataFrame | None = None, measures: Iterable[tuple] = MEASURES) -> DataFrame:
    """(load_id, row_no, k, problem): no VOYAGE, no WORK_DATE, no readable REPORTED, unknown equipment, a VOYAGE that repeats, a mode or
    direction without id. report and details are read once each. Without details these are the measures of the report's own rows, which are
    judged there and not unpivoted."""
    name = F.concat(F.lit("voyage "), F.coalesce("voyage", F.concat(F.lit("in row "), F.col("row_no").cast("string"))))
    said = lambda k, bad, *what: F.when(bad, F.struct(F.lit(k).alias("k"), F.concat(name, *(F.lit(w) if isinstance(w, str) else w for w in what)).alias("problem")))

    def found(rows: DataFrame, *problems: F.Column) -> DataFrame:
        return rows.select("load_id", "row_no", F.explode(F.array_compact(F.array(*problems))).alias("p")).select("load_id", "row_no", "p.*")

    same = Window.partitionBy("load_id", "voyage", F.when(F.col("voyage").isNull(), F.col("row_no")))  # rows without a voyage are no group
    rows = report.withColumns({"n": F.count("*").over(same), "last": F.max("row_no").over(same)})
    repeats = F.col("voyage").isNotNull() & (F.col("n") > 1) & (F.col("row_no") == F.col("last"))
    of_rows = found(
        rows,
        said(0, F.col("voyage").isNull(), " has no number"),
        said(1, F.col("work_date").isNull(), " has no WORK_DATE"),
        said(2, F.col("reported_at").isNull(), " has no readable REPORTED"),
        said(4, repeats, " comes more than once"),
        *(said(k, bad, *what) for k, bad, what in (measure_problems(measures) if details is None else ())),
    )
    if details is None:
        return of_rows
    odd = F.col("equipment_name").isNotNull() & ~F.col("equipment_name").isin(list(EQUIPMENT_TYPES))  # a fixed list
    unknown = [said(5, ~F.coalesce(F.col(c).isin(list(known)), F.lit(False)), f" has an unknown {c} ", F.coalesce(c, F.lit("NULL"))) for c, known in (("mode", MODES), ("direction", DIRECTIONS))]
    of_details = found(details, said(3, odd, " has equipment of no known type: ", F.col("equipment_name")), *unknown)
    return of_rows.unionByName(of_details)


def rejected(problems: DataFrame, told: int = TOLD, parts: int = 16) -> DataFrame:
    """(load_id, n_problems, message): the first `told` problems in the order of the file, and how many more there are.

    Problems are read once. Each of `parts` parts of a load keeps its count and its first `told`, so that no group is larger and a load of many problems
    is in many tasks.
    """
    order = ["row_no", "k", "problem"]
    part = Window.partitionBy("load_id", "part")
    kept = problems.withColumn("part", F.pmod(F.xxhash64("row_no"), F.lit(parts))).withColumns({"nth": F.row_number().over(part.orderBy(*order)), "n": F.count("*").over(part)})
    kept = kept.where(F.col("nth") <= told).groupBy("load_id", "part").agg(F.first("n").alias("n"), F.collect_list(F.struct(*order)).alias("p"))
    all_parts = kept.groupBy("load_id").agg(F.sum("n").alias("n_problems"), F.slice(F.sort_array(F.flatten(F.collect_list("p"))), 1, told).alias("p"))
    more = F.when(F.col("n_problems") > told, F.concat(F.lit("; and "), (F.col("n_problems") - told).cast("string"), F.lit(" more"))).otherwise("")
    return all_parts.select("load_id", "n_problems", F.concat(F.array_join("p.problem", "; "), more).alias("message"))


def unknown_gate_types(gates: DataFrame) -> DataFrame:
    """(load_id, message) of loads that name a gate type which does not exist."""
    odd = gates.where(F.col("gate_type_id").isNotNull() & ~F.col("gate_type_id").isin(list(GATE_TYPES))).select("load_id", "gate_type_id").distinct()
    nth = F.row_number().over(Window.partitionBy("load_id").orderBy("gate_type_id"))
    counts = odd.groupBy("load_id").agg(F.count("*").alias("n"))
    first = odd.withColumn("nth", nth).where(F.col("nth") <= TOLD).groupBy("load_id").agg(F.sort_array(F.collect_list("gate_type_id")).alias("ids"))
    more = F.when(F.col("n") > TOLD, F.concat(F.lit(" and "), (F.col("n") - TOLD).cast("string"), F.lit(" more"))).otherwise("")
    return counts.join(first, "load_id").select("load_id", F.concat(F.lit("gate types that do not exist: "), F.array_join(F.col("ids").cast("array<string>"), ", "), more).alias("message"))


def unreadable(rows: DataFrame) -> DataFrame:
    """(load_id, message) of loads with cells that are neither blank nor readable (rows has bad_cells)."""
    bad = rows.where("bad_cells > 0").groupBy("load_id").agg(F.count("*").alias("n"))
    return bad.select("load_id", F.concat(F.col("n").cast("string"), F.lit(" rows have unreadable cells")).alias("message"))
