import io
import json

from pyspark.sql import functions as F

from rollbook.operators import report
from rollbook.sources import feeds, pages, scans


def test_bounded_get_tries_again_and_stops():
    waits, answers = [], [(503, None), (200, io.BytesIO(b"abc"))]
    assert scans.bounded_get(lambda u: answers.pop(0), "https://x", sleep=waits.append) == b"abc" and waits == [1.5]
    waits.clear()
    assert scans.bounded_get(lambda u: (429, None), "https://x", sleep=waits.append) is None and waits == [1.5, 3.0]
    assert scans.bounded_get(lambda u: (404, io.BytesIO(b"x")), "https://x", sleep=waits.append) is None and len(waits) == 2
    assert scans.bounded_get(lambda u: (200, io.BytesIO(b"x" * 11)), "https://x", most=10) is None
    assert scans.bounded_get(lambda u: (200, io.BytesIO(b"x" * 10)), "https://x", most=10) == b"x" * 10

    def broken(url):
        raise OSError("down")

    assert scans.bounded_get(broken, "https://x", sleep=waits.append) is None and len(waits) == 4


def test_map_service_is_read_to_its_end():
    asked = []

    def service(total, flag):
        def get(url):
            at = int(url.split("resultOffset=")[1].split("&")[0])
            asked.append(at)
            rows = [{"attributes": {"Name": f"n{k}"}} for k in range(at, min(at + 3, total))]
            return json.dumps({"features": rows} | ({"exceededTransferLimit": True} if flag and at + 3 < total else {})).encode()

        return get

    items, trouble = feeds.walk_pages(lambda n: scans.map_pager(service(7, True), 3)("https://m/q", n), 20)
    assert len(items) == 7 and trouble is None and asked == [0, 3, 6]
    items, trouble = feeds.walk_pages(lambda n: scans.map_pager(service(6, False), 3)("https://m/q?a=1", n), 20)
    assert len(items) == 6 and trouble is None
    items, trouble = feeds.walk_pages(lambda n: scans.map_pager(service(100, True), 3)("https://m/q", n), 4)
    assert len(items) == 12 and trouble


def items(spark, rows):
    body = spark.createDataFrame(rows, "page_id long, url string, rank int, id string, city string")
    return body.select(
        "page_id", "url", "rank", F.from_json(F.to_json(F.struct("id", F.struct("city").alias("listingsBuildingAddress"))), feeds.ITEM).alias("item")
    )


def test_portals_take_the_first_way_that_gives(spark):
    portals = spark.createDataFrame([(k, c) for k, c in ((1, "Napa"), (2, ""), (3, ""), (4, None), (5, ""))], "page_id long, city string")
    shown = items(spark, [(1, "u", 0, "a", "NAPA"), (1, "u", 1, "b", "Gilroy"), (1, "u", 2, "a", "Napa"), (2, "u", 0, "c", None), (5, "u", 0, "x", ""), (5, "u", 1, "y", ""), (5, "u", 2, "z", "")])
    served = items(spark, [(1, "s", 0, "other", "Napa"), (3, "s", 0, "d", "X"), (3, "s", 1, "e", "X")])
    service = spark.createDataFrame([(3, False), (1, True), (4, True)], "page_id long, complete boolean")
    rows, ended = scans.portal_inventory(portals, shown, served, service, most=2)
    assert sorted((r.page_id, r["item"].id) for r in rows.collect()) == [(1, "a"), (2, "c"), (3, "d"), (3, "e"), (5, "x"), (5, "y")]
    assert {r.page_id: (r.path, r.error_kind) for r in ended.collect()} == {
        1: ("page", None), 2: ("page", None), 3: ("service", "incomplete"), 4: ("empty", "empty"), 5: ("page", "truncated"),
    }


SITE = """<ul role="presentation"><li><strong>Oak Homes - 3 available units</strong> call (408) 555-1234
<p><a href="/DocumentCenter/View/7/Oak-Homes-Flyer_50AMI">Official Flyer 50%AMI</a></p></li></ul>
<table><tr><th>Property, Address</th><th>Phone</th></tr><tr><td>Elm</td><td></td><td>1 Elm St</td></tr><tr></tr></table>
<a href="https://evil.example/x.pdf">x</a><a href="/docs/flyer-2.pdf">list</a><a href="/docs/agenda.pdf">agenda</a>"""


def test_city_page(spark):
    site = spark.createDataFrame([(1, "City", "https://x.example/list", SITE), (2, "Town", "https://y.example", "<p>nothing</p>")], "page_id long, authority string, url string, html string")
    read = spark.createDataFrame([("https://x.example/docs/flyer-2.pdf", "Pine Court 12 Pine Street, Gilroy (408) 555-9999\nshort")], "href string, text string")
    rows, ended = scans.city_page(site, read)
    got = {(r.method, r.property_name) for r in rows.collect()}
    assert ("availability_list", "Oak Homes") in got and ("table", "Elm") in got and ("document", "Pine Court") in got and len(got) == 3
    assert {(r.page_id, r.n, r.documents, r.beyond, r.had_error) for r in ended.collect()} == {(1, 3, 2, 0, False), (2, 0, 0, 0, True)}
    short = scans.city_page(site, read, budget=1)[1].where("page_id = 1").first()
    assert short.beyond == 1 and short.had_error and short.n >= 2
    flyers = scans.flyer_links(pages.links(site)).collect()
    assert [(f.name, f.href) for f in flyers] == [("Oak Homes", "https://x.example/DocumentCenter/View/7/Oak-Homes-Flyer_50AMI")]
    bare = spark.createDataFrame([("https://x/DocumentCenter/View/9/Oak-Homes-Flyer_50AMI",), ("https://x/other",)], "href string")
    assert [r[0] for r in bare.select(scans.document_title(F.col("href"))).collect()] == ["Oak Homes (50% AMI)", ""]


def test_map_page_takes_its_own_data_or_the_first_link_with_any(spark):
    layer = 'var x = {"features": [{"properties": {"Name": "%s"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]};'
    site = spark.createDataFrame([(1, "A", "https://a.example", layer % "Own"), (2, "B", "https://b.example", "<p></p>")], "page_id long, authority string, url string, html string")
    linked = spark.createDataFrame([(2, "https://b.example/none.js", 1), (2, "https://b.example/gis.js", 2), (2, "https://b.example/gis2.js", 3)], "page_id long, href string, nth int")
    layers = spark.createDataFrame([("https://b.example/none.js", "no data"), ("https://b.example/gis.js", layer % "First"), ("https://b.example/gis2.js", layer % "Second")], "href string, body string")
    assert sorted(r.property_name for r in scans.map_page(site, linked, layers).collect()) == ["First", "Own"]


def test_settings_and_cities(spark):
    text = "other:\n  prune:\n    default_not_seen_days: 9\ndatabase:\n  # note\n  prune:\n    keep: 1\n    default_not_seen_days: 30 # days\n"
    assert scans.prune_days(text) == 30
    assert [scans.prune_days(x) for x in (None, "", "database: 3", text.replace("30", "many"))] == [45, 45, 45, 45]
    df = spark.createDataFrame([("City of Napa (BMR)",), ("Town of Los Gatos",), ("County",), (None,)], "authority string")
    assert [r[0] for r in df.select(scans.city_of(F.col("authority"))).collect()] == ["Napa", "Los Gatos", "County", ""]


def test_reports(spark):
    rows = spark.createDataFrame(
        [("A", "STALE"), ("A", "NEW"), ("B", "SCRAPE_FAILED"), ("B", "SCRAPE_FAILED")], "authority string, change_type string"
    )
    proposal = report.prune_proposal(rows)
    assert {tuple(r) for r in proposal.collect()} == {("A", 1, 0), ("B", 0, 2)}
    note = report.prune_note(proposal, "r1")
    assert "looked at: 1" in note and "not to be pruned: 2" in note and "| A |" in note
    assert "Nothing to prune" in report.prune_note(proposal.limit(0), "r1")
    diff = spark.createDataFrame([("A", None, "u", "STALE")], "source_authority string, property_name string, url string, change_type string")
    assert [tuple(r) for r in report.rekeyed(diff).collect()] == [("A", "", "u", "STALE")]
    events = spark.createDataFrame([("STATUS_CHANGE", "A", "Oak", "u", "open", "closed"), ("ADDED", "A", "Elm", "v", None, None)], "event string, authority string, property_name string, url string, old string, new string")
    assert [tuple(r) for r in report.changelog_csv(events).collect()] == [("STATUS_CHANGE", "A", "Oak", "u", "open → closed"), ("ADDED", "A", "Elm", "v", "")]
