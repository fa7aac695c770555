"""Windows against a file-by-file fold in plain Python, on random histories."""

import datetime as dt
import random

from tests.test_edges import files, report

from portflow.operators import voyage


def fold(history, dates):
    """history: load -> voyages; the rule as it is told: a voyage to call that the next file lacks is classified."""
    status, last = {}, {}
    for load in sorted(history):
        for v in history[load]:
            status[v], last[v] = 1, load
        for v, s in status.items():
            if s == 1 and v not in history[load] and dates[v, last[v]] is not None:
                status[v] = dates[v, last[v]]
    return status


def test_fall_off_equals_fold(spark):
    rng = random.Random(3)
    for _ in range(6):
        history = {load: {v for v in "ABCDEF" if rng.random() < 0.5} if rng.random() < 0.85 else set() for load in range(1, 9)}
        rows, dates = [], {}
        for load, voyages in history.items():
            for k, v in enumerate(sorted(voyages)):
                gap = rng.choice([0, 1, 2, None])
                dates[v, load] = None if gap is None else 2 if gap <= 1 else 3
                on = dt.date(2026, 1, 1) + dt.timedelta(days=load)
                rows.append((load, k, v, None if gap is None else str(on + dt.timedelta(days=gap)), f"{on}T05:00:00"))
        got = {r.voyage: r.voyage_status_id for r in voyage.status_current(report(spark, rows), files(spark, history)).collect()}
        assert got == fold(history, dates)
