import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from rollbook.functions.times import iso_second, iso_text
from rollbook.operators import history

SCHEMA = "listing_id long, update_id string, listing_status string, first_seen string, last_seen string, received_at timestamp_ntz, entity string, value long"


def read(spark, rows):
    raw = spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)
    return history.readings(
        raw, "listing_id", "listing_status", iso_second(F.col("last_seen")), iso_second(F.col("first_seen")), "received_at", F.col("update_id")
    )


def chains(df):
    return sorted(
        (r.entity, r.value, r.f, r.t or "")
        for r in df.select("entity", "value", iso_text(F.col("valid_from")).alias("f"), iso_text(F.col("valid_to")).alias("t")).collect()
    )


def brute(rows):
    """Versions by plain loops."""
    def second(x):
        x = (x or "").strip().replace(" ", "T").rstrip("Z")[:19]
        return x or None

    by, born = {}, {}
    for i, u, st, first, last, rec in rows:
        if i is None:
            continue
        if second(first):
            born[i] = min(born.get(i, "9"), second(first))
        st = (st or "").strip().lower()
        if st and second(last):
            k = by.setdefault(i, {})
            k[second(last)] = max(k.get(second(last), (datetime.min, "", "")), (rec, u, st))
    out = []
    for i, k in by.items():
        versions = []
        for t in sorted(k):
            if not versions or versions[-1][0] != k[t][2]:
                versions.append([k[t][2], t])
        if born.get(i, "9") < versions[0][1]:
            versions[0][1] = born[i]
        for n, (st, t) in enumerate(versions):
            out.append((i, st, t, versions[n + 1][1] if n + 1 < len(versions) else ""))
    return sorted(out)


def sample(n, seed, hot=False):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        t = datetime(2025, 1, 1) + timedelta(hours=rng.randrange(24 * 60), seconds=rng.randrange(3))
        spell = rng.choice(["%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S.000"])
        entity = 1 if hot and k % 3 else rng.randrange(1, 6)
        rows.append(
            (
                rng.choice([entity] * 9 + [None]), f"u{rng.randrange(n):04d}", rng.choice(["open", " Open ", "closed", "CLOSED", "waitlist", "", None]),
                rng.choice([None, "", (t - timedelta(days=rng.randrange(40))).strftime(spell)]), rng.choice([t.strftime(spell)] * 9 + [None]),
                t + timedelta(hours=rng.randrange(900)),
            )
        )
    return rows + rows[: n // 10]


def test_chains_equal_plain_loops(spark):
    for seed, hot in ((1, False), (2, True)):
        rows = sample(400, seed, hot)
        assert chains(history.build_chains(read(spark, rows))) == brute(rows)
        assert chains(history.build_chains(read(spark, rows), bucket="month")) == brute(rows)


def test_late_batch_rebuilds_touched_chains_only(spark):
    rows = sample(300, 3)
    old, late = rows[:200], rows[200:]
    built = history.build_chains(read(spark, old))
    again = history.rebuild_affected(built, read(spark, old), read(spark, late))
    assert chains(again) == brute(rows)
    twice = history.rebuild_affected(again, read(spark, rows), read(spark, late))
    assert chains(twice) == brute(rows)
    same = history.rebuild_affected(built, read(spark, old), read(spark, []))
    assert chains(same) == brute(old)


def test_empty_and_missing(spark):
    assert chains(history.build_chains(read(spark, []))) == []
    t = datetime(2025, 1, 1)
    rows = [(1, "u", None, "2025-01-01", "2025-01-02", t), (2, "u", "open", None, "no time", t), (None, "u", "open", None, "2025-01-02", t)]
    assert chains(history.build_chains(read(spark, rows))) == []


def test_store_swaps_whole_states(spark, tmp_path):
    rows = sample(120, 5)
    store = history.ChainStore(spark, str(tmp_path))
    assert store.current() is None
    store.apply(read(spark, []), read(spark, rows[:80]))
    assert chains(store.current()) == brute(rows[:80])
    store.apply(read(spark, rows[:80]), read(spark, rows[80:]))
    assert chains(store.current()) == brute(rows)


def test_batches_leave_other_buckets_alone(spark, tmp_path):
    rows = sample(200, 6)
    late = [r for r in sample(40, 7) if r[0] == 2]
    store = history.ChainStore(spark, str(tmp_path), buckets=8)
    store.apply(read(spark, []), read(spark, rows))
    before = store.contents()
    files = {k: sorted((f.name, f.stat().st_mtime_ns) for f in (tmp_path / v).iterdir()) for k, v in before.items()}
    store.apply(read(spark, rows), read(spark, late))
    after = store.contents()
    assert chains(store.current()) == brute(rows + late)
    same = [k for k in before if after.get(k) == before[k]]
    assert len(same) == len(before) - 1 and all(sorted((f.name, f.stat().st_mtime_ns) for f in (tmp_path / after[k]).iterdir()) == files[k] for k in same)
    assert store.vacuum() == 1 and chains(store.current()) == brute(rows + late)


def test_late_readings_marked_in_one_pass(spark):
    rows = sample(300, 9)
    cases = (F.lit(False), F.lit(True), F.col("received") >= F.lit(datetime(2025, 1, 30)))
    assert all(chains(history.chains_after(read(spark, rows), late)) == brute(rows) for late in cases)
