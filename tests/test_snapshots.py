import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd

from rollbook.operators.snapshots import _diff_sorted, diff_bucket, snapshot_changes

SNAP = "run_id string, listing_id long, authority string, property_name string, listing_status string, last_seen string, loaded_at timestamp_ntz, run string, entity long"
RUNS = ["20250101T000000", "20250108T000000", "20250115T000000", "20250122T000000"]


def tables(spark, rows, fails=(), partial=()):
    snap = spark.createDataFrame([(*r, "clash", 1) for r in rows], SNAP)
    history = spark.createDataFrame([(r, "x" if r in partial else None) for r in RUNS], "run_id string, authority_filter string")
    outcomes = spark.createDataFrame([(r, a, True) for r, a in fails] + [(RUNS[0], "Z", False)], "run_id string, authority string, had_error boolean")
    return snap, history, outcomes


def brute(rows, fails=(), partial=()):
    def fold(x):
        return "".join((x or "").lower().split())

    runs = [r for r in RUNS if r not in partial]
    start = {r: f"{r[:4]}-{r[4:6]}-{r[6:8]}T00:00:00" for r in runs}
    present = {r: {} for r in runs}
    for run, i, a, name, st, seen, loaded in rows:
        if run in present and i is not None and seen and seen.replace(" ", "T").rstrip("Z") >= start[run]:
            old = present[run].get(i)
            if old is None or loaded >= old[0]:
                present[run][i] = (loaded, a, (fold(name), fold(st)))
    state, out = {}, []
    for k, r in enumerate(runs):
        bad = {a for x, a in fails if x == r}
        now = {i: v for i, v in present[r].items() if v[1] not in bad}
        was = {i: v for i, v in state.items() if v[1] not in bad}
        if k:
            out += [(r, i, "ADDED") for i in now if i not in was]
            out += [(r, i, "REMOVED") for i in was if i not in now]
            out += [(r, i, "CHANGED") for i in now if i in was and now[i][2] != was[i][2]]
        state = {i: v for i, v in state.items() if v[1] in bad} | now
    return sorted(out)


def sample(seed, n=40):
    rng = random.Random(seed)
    rows, serial = [], 0
    for r in RUNS:
        for i in range(n):
            for _ in range(rng.choice([0, 1, 1, 1, 2])):
                serial += 1
                day = f"{r[:4]}-{r[4:6]}-{r[6:8]}"
                seen = rng.choice([f"{day}T01:00:00", f"{day} 02:00:00Z", f"{day}T03:00:00.000", "2024-12-01T00:00:00", None, "junk"] if rng.random() < 0.3 else [f"{day}T01:00:00"])
                rows.append((r, i, "A" if i % 2 else "B", rng.choice(["Oak House", "oak  house ", "Elm"]) + str(i), rng.choice(["open", "Open", "closed", None, ""]), seen, datetime(2025, 2, 1) + timedelta(seconds=serial)))
    rows.append((RUNS[1], None, "A", "x", "open", "2025-01-08T01:00:00", datetime(2025, 2, 1)))
    return rows


def found(df):
    return sorted(tuple(r) for r in df.select("run_id", "listing_id", "change_type").collect())


def test_equals_plain_loops(spark):
    for seed, fails, partial in ((1, (), ()), (2, ((RUNS[1], "A"), (RUNS[2], "A"), (RUNS[0], "B")), ()), (3, ((RUNS[3], "B"),), (RUNS[2],))):
        rows = [r for r in sample(seed) if r[5] != "junk" or True]
        clean = [r if r[5] != "junk" else (*r[:5], None, r[6]) for r in rows]
        assert found(snapshot_changes(*tables(spark, rows, fails, partial))) == brute(clean, fails, partial)


def test_repeated_rows_change_nothing(spark):
    rows = sample(4)
    assert found(snapshot_changes(*tables(spark, rows + rows))) == found(snapshot_changes(*tables(spark, rows)))


def test_empty_tables(spark):
    snap, history, outcomes = tables(spark, [])
    assert found(snapshot_changes(snap, history, outcomes)) == []
    assert found(snapshot_changes(tables(spark, sample(5))[0], history.limit(0), outcomes.limit(0))) == []


def test_values_of_changed_rows(spark):
    t = datetime(2025, 2, 1)
    rows = [(RUNS[0], 1, "A", "Oak", "open", "2025-01-01T01:00:00", t), (RUNS[1], 1, "A", "Oak", "closed", "2025-01-08T01:00:00", t), (RUNS[1], 2, "A", "New", "open", "2025-01-08T01:00:00", t)]
    got = snapshot_changes(*tables(spark, rows), with_values=True).collect()
    assert [(r.listing_id, r.listing_status_before, r.listing_status_after) for r in got] == [(1, "open", "closed")]


def test_values_before_a_failed_run(spark):
    """Rows of a run in which their source failed are not the state before, whatever another source says of the listing."""
    t, later = datetime(2025, 2, 1), datetime(2025, 2, 2)
    rows = [
        (RUNS[0], 1, "A", "Oak", "open", "2025-01-01T01:00:00", t), (RUNS[1], 1, "A", "Oak", "closed", "2025-01-08T01:00:00", t), (RUNS[2], 1, "A", "Oak", "closed", "2025-01-15T01:00:00", t),
        (RUNS[0], 2, "B", "Elm", "open", "2025-01-01T01:00:00", t), (RUNS[1], 2, "B", "Elm", "waitlist", "2025-01-08T01:00:00", t), (RUNS[2], 2, "B", "Elm", "closed", "2025-01-15T01:00:00", t),
        (RUNS[0], 3, "A", "Ash", "open", "2025-01-01T01:00:00", t), (RUNS[1], 3, "B", "Ash", "waitlist", "2025-01-08T01:00:00", t), (RUNS[1], 3, "A", "Ash", "closed", "2025-01-08T01:00:00", later), (RUNS[2], 3, "A", "Ash", "closed", "2025-01-15T01:00:00", t),
    ]
    got = snapshot_changes(*tables(spark, rows, fails=((RUNS[1], "A"),)), with_values=True).collect()
    assert sorted((r.run_id, r.listing_id, r.listing_status_before, r.listing_status_after) for r in got) == [
        (RUNS[1], 2, "open", "waitlist"), (RUNS[2], 1, "open", "closed"), (RUNS[2], 2, "waitlist", "closed"), (RUNS[2], 3, "open", "closed"),
    ]


def test_sorted_differences():
    added, removed, changed = _diff_sorted(np.array([1, 3, 5]), np.array([9, 9, 9]), np.array([1, 4, 5]), np.array([9, 9, 8]))
    assert added.tolist() == [False, True, False] and removed.tolist() == [False, True, False] and changed.tolist() == [False, False, True]
    none = pd.DataFrame({"run": [], "entity": [], "row_hash": [], "fails": []}).astype({"run": "int64", "entity": "int64", "row_hash": "int64", "fails": "object"})
    assert len(diff_bucket(none, [1, 2])) == 0
