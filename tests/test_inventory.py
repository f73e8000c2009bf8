import random

from pyspark.sql import functions as F

from rollbook.operators import canonical, changes, report, resolve, signals
from rollbook.operators import inventory as inv
from rollbook.plans.pipeline import run

NOW = "2025-01-02T00:00:00"


def raw(spark, *rows):
    names = sorted({k for r in rows for k in r}) or ["authority"]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"{n} {'long' if n == 'seq' else 'string'}" for n in names))


def test_canonical_row(spark):
    r = canonical.canonical_rows(
        raw(spark, dict(authority=" City of X ", property_name="Oak", address="1 Elm St, X", phone="5", bedrooms="2BR", listing_status=" OPEN ", notes="nice", document_url="", seq=1, odd="extra")), NOW
    ).first()
    assert (r.authority, r.url, r.status, r.listing_status, r.unit_types) == ("City of X", "roll:addr:1elmst", "Open", "open", "2BR")
    assert r.notes == "nice | addr: 1 Elm St, X | phone: 5 | br: 2BR" and r.last_seen == NOW and r.expires_at == ""


def test_canonical_rows_pass_and_gaps(spark):
    done = canonical.canonical_rows(raw(spark, dict(authority="eah", property_name="N", scrape_date="d", status="weird", seq=1)), NOW).first()
    assert done.authority == "eah" and done.status == "weird" and done.url is None
    rows = canonical.canonical_rows(raw(spark, dict(authority=None, property_name=None, seq=1), dict(authority="A", property_name="P", status=None, seq=2)), NOW)
    assert canonical.complete(rows).count() == 1
    assert rows.where("authority = 'A'").first().status == "Unknown"
    assert canonical.canonical_rows(raw(spark).limit(0), NOW).count() == 0


def test_surrogates_differ_by_source(spark):
    rows = canonical.canonical_rows(
        raw(spark, *[dict(authority="A", property_name="P", source_url=u, seq=k) for k, u in enumerate(["", "https://a.example/list1", "https://a.example/list2"])]), NOW
    ).orderBy("seq").collect()
    assert len({r.url for r in rows}) == 3 and rows[0].url.startswith("roll:prop:a:") and rows[1].url.startswith("roll:src:a:")


def greedy(rows):
    order = sorted(rows, key=lambda r: r["rank"])
    seen, kept = set(), set()
    for r in order:
        names = {"i" + r["ident"]} | ({"c" + r["cross"]} if r["cross"] is not None else set())
        if not names & seen:
            seen |= names
            kept.add(r["seq"])
    return kept


def test_exact_survivors_equal_the_scan(spark):
    rng = random.Random(7)
    for chain in (False, True):
        rows = []
        for k in range(60):
            if chain:
                name, where = f"n{(k + 1) // 2}", f"{100 + k // 2} elm st, x"
            else:
                name, where = f"n{rng.randrange(12)}", rng.choice(["", f"{100 + rng.randrange(12)} elm st, x"])
            rows.append(dict(authority="A", property_name=name, url="", address=where, phone="", email="", confidence=rng.choice(["high", "medium", "low", "0.9", ""]), seq=k))
        df = raw(spark, *rows)
        wanted = greedy([r.asDict() for r in resolve.keyed(df).collect()])
        assert {r.seq for r in resolve.survivors_exact(df).collect()} == wanted
        assert {r.seq for r in resolve.survivors_exact(df).collect()} == wanted


def test_survivors_of_nothing(spark):
    empty = raw(spark, dict(authority="A", property_name="n", url="", address="", phone="", email="", confidence="", seq=1)).limit(0)
    assert resolve.survivors(empty, "exact").count() == resolve.survivors(empty, "functional").count() == 0


def listing(authority, name, **more):
    return dict(authority=authority, property_name=name, url=f"https://x.example/{name}", address="", phone="", email="", confidence="high", listing_status="open") | more


def test_runs_new_stale_failed_and_idempotent(spark, tmp_path):
    store = inv.InventoryStore(spark, str(tmp_path / "store"))
    targets = spark.createDataFrame([("A", "eden", None, None), ("B", "no_public_list", None, None)], "authority string, scraping_measures string, validated_zero string, validated_zero_review_due string")
    fine = spark.createDataFrame([("A", False), ("B", False)], "authority string, had_error boolean")
    one = [dict(listing("A", f"P{k}"), seq=k) for k in range(20)] + [dict(listing("B", f"Q{k}"), seq=90 + k) for k in range(3)]
    first = run(store, raw(spark, *one), targets, fine, "R1", "2025-01-01T00:00:00", out=str(tmp_path / "out"))
    assert {r.change_type: r.n for r in first.counts.collect()} == {"NEW": 23, "UPDATED": 0, "STALE": 0, "SCRAPE_FAILED": 0}
    assert first.baseline_updated and store.previous_full_run() == "R1"
    two = [r for r in one if r["property_name"] != "P0" and r["authority"] == "A"]
    two[0] = dict(two[0], listing_status="closed")
    failed = spark.createDataFrame([("A", False), ("B", True)], "authority string, had_error boolean")
    second = run(store, raw(spark, *two), targets, failed, "R2", "2025-01-02T00:00:00", out=str(tmp_path / "out"))
    assert {r.change_type: r.n for r in second.counts.collect()} == {"NEW": 0, "UPDATED": 19, "STALE": 1, "SCRAPE_FAILED": 3}
    events = sorted((r.event, r.property_name) for r in second.events.collect())
    assert events == [("REMOVED", "P0")] + [("SCRAPE_FAILED", f"Q{k}") for k in range(3)] + [("STATUS_CHANGE", "P1")]
    assert not second.baseline_updated and store.previous_full_run() == "R1"
    before = sorted(map(tuple, store.read().collect()))
    run(store, raw(spark, *two), targets, failed, "R2", "2025-01-02T00:00:00")
    assert sorted(map(tuple, store.read().collect())) == before
    assert (tmp_path / "out" / "diff.csv").read_text().startswith("change_type,source_authority")
    assert "Removed" in (tmp_path / "out" / "summary.md").read_text()
    assert "change_type,authority" in (tmp_path / "out" / "changelog.csv").read_text() and "did not confirm" in (tmp_path / "out" / "proposed_prune.md").read_text()
    part = run(store, raw(spark, *two), targets, fine, "R3", "2025-01-03T00:00:00", partial=spark.createDataFrame([("A",)], "authority string"), out=str(tmp_path / "out"))
    assert {r.authority for r in part.labelled.select("authority").distinct().collect()} == {"A"} and not part.baseline_updated


def test_prune_rules(spark):
    rows = spark.createDataFrame([("A", "1", "2025-01-01", ""), ("A", "2", "2025-03-01", "2024-01-01"), ("B", "3", "2024-01-01", None)], "authority string, property_name string, last_seen string, expires_at string")

    def left(**rule):
        return {r.property_name for r in inv.prune(rows, inv.prune_rule("2025-03-10", **rule)).collect()}

    assert left() == {"1", "2", "3"}
    assert left(not_seen_days=30) == {"2"}
    assert left(expires_past=True) == {"1", "3"} and left(expires_past=True, text_expiry=True) == {"3"}
    assert left(all_stale=True) == set() and left(not_seen_days=30, authority="B") == {"1", "2"}


def test_store_versions(spark, tmp_path):
    store = inv.InventoryStore(spark, str(tmp_path / "s"))
    assert store.read().count() == 0 and store.previous_full_run() is None and store.baseline().count() == 0
    rows = inv.incoming(canonical.canonical_rows(raw(spark, dict(listing("A", "P"), seq=1)), NOW), "R1")
    store.write(rows)
    store.snapshot("before", "20250101")
    assert store.snapshots()[0]["rows"] == 1 and store.info()["rows"] == 1
    store.write(rows.limit(0))
    assert store.read().count() == 0
    store.restore(store.snapshots()[0]["folder"])
    assert store.read().count() == 1
    store.log_run("--prune", "x", None, 1, 0)
    assert store.previous_full_run() is None and store.history().count() == 1
    try:
        store.drop("drop")
        raise AssertionError
    except ValueError:
        pass
    store.drop("DROP")
    assert store.read().count() == 0


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    inv.write_csv(spark.createDataFrame([("=a", 'q"x,\ny'), (None, "b")], "k string, v string"), path)
    rows = inv.read_csv(spark, path, ("k", "v")).collect()
    assert sorted((r.k, r.v) for r in rows) == [("", "b"), ("'=a", 'q"x,\ny')]
    assert inv.read_csv(spark, str(tmp_path / "none.csv"), ("k",)).count() == 0


def test_labels_by_rule(spark):
    rows = spark.createDataFrame(
        [("R2", "R2", "a", "b", False, "NEW"), ("R2", "R1", "a", "b", False, "UPDATED"), (" R2 ", None, "a", "a", False, "NEW"), ("R2", "", "a", "b", False, "UPDATED"), ("R1", "R1", "a", "b", True, "SCRAPE_FAILED"), (None, "R1", "a", "b", False, "STALE")],
        "last_run_id string, first_run_id string, first_seen string, last_seen string, f boolean, wanted string",
    )
    assert rows.where(changes.change_label("R2", F.col("f")) != F.col("wanted")).count() == 0


def test_signals(spark):
    targets = spark.createDataFrame(
        [("Z", "eden", "", ""), ("V", "eden", "2025-01-01", "2025-12-01"), ("D", "eden", "2024-01-01", "2024-06-01"), ("L", "midpen", "", ""), ("F", "eden", "", ""), ("P", "housekeys", "", ""), ("N", None, None, None)],
        "authority string, scraping_measures string, validated_zero string, validated_zero_review_due string",
    )
    counts = spark.createDataFrame([("L", 5)], "authority string, n long")
    failed = spark.createDataFrame([("F",)], "authority string")
    got = {r.authority: r.signal for r in signals.source_signals(targets, counts, failed, "2025-06-01").collect()}
    assert got == {"Z": "suspicious_zero", "V": None, "D": "suspicious_zero", "L": "low_yield", "F": None, "P": None, "N": None}
    s = signals.source_signals(targets, counts, failed, "2025-06-01")
    assert {r.authority for r in signals.unreliable(s).collect()} == {"Z", "D", "L", "F"}
    labels = spark.createDataFrame([("STALE", 1)], "change_type string, n long")
    assert signals.needs_attention(s, labels).first()[0] is True
    assert signals.needs_attention(s.limit(0), labels).first()[0] is False


def test_changelog_rows(spark):
    none = spark.createDataFrame([], "event string, authority string, property_name string, url string, old string, new string")
    assert [r.event for r in changes.changelog(none, False).collect()] == ["NO_CHANGE"]
    assert [r.event for r in changes.changelog(none, True).collect()] == ["INITIAL_RUN"]
    skipped = spark.createDataFrame([("S",)], "authority string")
    log = changes.changelog(none, False, skipped)
    assert "S" in report.markdown_changelog(log)
