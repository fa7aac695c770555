import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"


def plain(v):
    """A value as both engines give it."""
    import pandas as pd

    if not isinstance(v, (str, list, dict)) and pd.isna(v):
        return None
    if hasattr(v, "year"):
        return str(pd.Timestamp(v))
    if isinstance(v, float):
        return int(v) if v == int(v) else round(v, 9)
    return v.item() if hasattr(v, "item") else v


def rows_of(frame, columns):
    return sorted(str(tuple(plain(v) for v in r)) for r in frame[columns].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.fixture
def same(spark, duck):
    """Holds a query against its SQL."""

    def check(query, sql):
        ours, theirs = query(spark, SF).toPandas(), duck.sql(sql).df()
        columns = sorted(ours.columns)
        assert columns == sorted(theirs.columns)
        assert rows_of(ours, columns) == rows_of(theirs, columns)

    return check


@pytest.fixture
def windowed():
    """Runs a frame and gives the rows that were shuffled to each of its windows."""

    def below(node, window):
        name, found = node.nodeName(), []
        if name.startswith("AdaptiveSparkPlan"):
            return below(node.executedPlan(), window)
        if name.endswith("QueryStage"):
            return below(node.plan(), window)
        if name == "ReusedExchange":
            return below(node.child(), window)
        if window and name == "Exchange":
            found, window = [node.metrics().apply("shuffleRecordsWritten").value()], False
        children = node.children()
        return found + [n for i in range(children.size()) for n in below(children.apply(i), window or name == "Window")]

    def run(frame):
        frame.collect()
        return below(frame._jdf.queryExecution().executedPlan(), False)

    return run
