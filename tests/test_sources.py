import json
import re

import pytest

from rollbook.plans import catalog
from rollbook.sources import documents as docs
from rollbook.sources import feeds, pages, registry

TABLE = """# Sources

a | b
| City/Authority | URL | Notes | Scraping Measures | Priority | Last Seen |
|---|---|---|---|---|---|
| City of X | https://x.example/h | fine | eden; eden, PDF | High | |
| City of Y | file:///etc | n | pdf | Low | |
| City of Z | https://z.example | a \\| b | pdf | Low | |
"""


def test_registry(spark, tmp_path):
    f = tmp_path / "t.md"
    f.write_text(TABLE)
    rows, bad = registry.read_table(spark, str(f))
    got = rows.collect()
    assert [(r.authority, r.scraping_measures, r.administrator) for r in got] == [("City of X", "eden,pdf", "")]
    assert {(r.authority, r.reason) for r in bad.collect()} == {("City of Y", "no usable link"), ("City of Z", "bar in notes")}
    assert registry.reload_targets(spark, str(f), str(tmp_path / "targets")) == 1
    f.write_text(TABLE.replace("URL |", "Link |"))
    with pytest.raises(registry.HeaderError):
        registry.reload_targets(spark, str(f), str(tmp_path / "targets"))
    assert spark.read.parquet(str(tmp_path / "targets")).count() == 1


CARDS = {
    "alta": ('<div class="prop-box"><span class="prop-flag">Waitlist Open</span><h3 class="prop-title"><a href="/p/1">Oak</a></h3><p class="block-desc">1 Elm St</p></div>' * 2,
             [{"property_name": "Oak", "url": "https://x.example/p/1", "status": "Waitlist Open", "listing_status": "waitlist", "address": "1 Elm St"}]),
    "charities_housing": ('<div class="h_apart_ctc"><a href="/oak">Oak &amp; Elm</a><a href="javascript:;">1 Elm St, X, CA, USA</a><a href="mailto:a@b.example">m</a><a href="tel:555">555-1</a><span class="unit-type">Studio</span></div>',
                          [{"property_name": "Oak & Elm", "url": "https://x.example/oak", "address": "1 Elm St, X, CA", "email": "a@b.example", "phone": "555-1", "unit_types": "Studio"}]),
    "midpen": ('<div class="elementor-location-single"><a href="/property/oak"><img></a><a href="/property/oak">Oak</a><p>Senior, Wait list open. Campbell, CA</p></div><div class="elementor-location-single"><a href="/property/a">A</a><a href="/property/b">B</a></div>',
               [{"property_name": "Oak", "url": "https://x.example/property/oak", "listing_status": "waitlist", "address": "Campbell, CA", "eligibility_flags": "senior"}]),
    "eden": ('<ul><li><a href="/oak">Closed</a><a href="/oak">Oak</a> Hayward, California 30 units</ul>',
             [{"property_name": "Oak", "url": "https://x.example/oak", "listing_status": "closed", "status": "Closed", "address": "Hayward, CA", "unit_types": "30 units"}]),
    "eah": ('<ul><li><h2><a href="/oak">Oak</a></h2><p>1 Elm St, Gilroy, California 95020</p></ul>',
            [{"property_name": "Oak", "url": "https://x.example/oak", "address": "1 Elm St, Gilroy, CA 95020", "city": "Gilroy"}]),
    "first_housing": ('<div><h4>12 Elm Street, San Jose, CA 95110</h4><p>(408) 555-1234 a@b.example</p><a href="/oak-creek">More</a></div>',
                      [{"property_name": "Oak Creek", "url": "https://x.example/oak-creek", "address": "12 Elm Street, San Jose, CA 95110", "phone": "(408) 555-1234", "email": "a@b.example"}]),
    "scc_boxes": ('<div class="property-box"><h3>Oak</h3>12 Elm Street, San Jose, CA 95110 <p>20 units for Family, open</p></div>',
                  [{"property_name": "Oak", "address": "12 Elm Street, San Jose, CA 95110", "unit_types": "20 units", "eligibility_flags": "family", "listing_status": "open"}]),
    "availability": ('<ul role="presentation"><li><strong>Oak Homes - 3 available units</strong> call (408) 555-1234</ul>',
                     [{"property_name": "Oak Homes", "unit_types": "3 available", "phone": "(408) 555-1234"}]),
    "labelled": ('<h1>Oak</h1><p>Address: 1 Elm St</p><p>Phone: 555</p><p>Status: open</p><a href="f.pdf">f</a>',
                 [{"property_name": "Oak", "url": "https://x.example/", "address": "1 Elm St", "phone": "555", "status": "open", "notes": "https://x.example/f.pdf"}]),
}


@pytest.mark.parametrize("kind", list(CARDS))
def test_cards(spark, kind):
    html, wanted = CARDS[kind]
    df = spark.createDataFrame([(1, "https://x.example/", html), (2, "https://x.example/", None), (3, None, "<p>unclosed <b>")], "page_id long, url string, html string")
    got = [{k: v for k, v in r.record.items() if k != "source_url"} for r in pages.page_records(df, kind).orderBy("page_id", "seq").collect()]
    assert got == wanted


def test_tables_links_and_budget(spark):
    html = "<table><tr><th>Property Name<th>Phone<tr><td>Oak<td>555<tr><td><td></table>" + "".join(f'<a href="/d{k}.pdf">{n}</a>' for k, n in enumerate(["Agenda", "Oak Homes - 2 available units", "x"]))
    html += '<a href="/d1.pdf">again</a><a href="/agenda.pdf">no</a><a href="/flyer.pdf">f</a>'
    df = spark.createDataFrame([(1, "https://x.example/", html)], "page_id long, url string, html string")
    assert [r.cells for r in pages.table_rows(df).collect()] == [{"property_name": "Oak", "phone": "555"}]
    links = pages.links(df)
    todo = pages.documents_to_read(links, budget=2).orderBy("nth").collect()
    assert [(r.href.rsplit("/")[-1], r.within_budget) for r in todo] == [("flyer.pdf", True), ("d0.pdf", True), ("d1.pdf", False), ("d2.pdf", False)]
    names = pages.flyer_names(links)
    recs = spark.createDataFrame([("https://x.example/d1.pdf", "x"), ("https://x.example/none.pdf", "y")], "document_url string, property_name string")
    assert {r.property_name for r in pages.fill_names(recs, names).collect()} == {"Oak Homes", "y"}


def test_routes(spark):
    df = spark.createDataFrame([("https://a/x.js", "gis"), ("https://a/x", "eden"), ("https://a/wp-json", "john_stewart"), ("https://a", "bloom,no_public_list"), ("https://a", "housekeys")], "url string, scraping_measures string")
    assert [r[0] for r in df.select(pages.route()).collect()] == ["gis_script", "eden", "jsco", None, "housekeys"]
    full = spark.createDataFrame([("A", "https://a", None, "housekeys")], "authority string, url string, administrator_url string, scraping_measures string")
    assert pages.portal_rows(full).first().status == "registration required"


def test_portal_items(spark):
    item = dict(id="7", name=" Oak ", status="closed", isWaitlistOpen=True, waitlistOpenSpots=3, leasingAgentPhone="5", urlSlug="oak", applicationDueDate="2025-01-02T00", applicationFee="10",
                listingsBuildingAddress=dict(street="1 Elm", city="X", state="CA", zipCode="9"), units=[dict(numBedrooms=1, amiPercentage="60"), dict(numBedrooms=0, amiPercentage="30"), dict(numBedrooms=1, amiPercentage="50")])
    body = json.dumps({"props": {"pageProps": {"openListings": [item, item, dict(name="")], "closedListings": [dict(name="B", unitsAvailable=2, buildingTotalUnits=9)]}}})
    df = spark.createDataFrame([(1, "https://p.example/listings", f'<script id="__NEXT_DATA__">{body}</script>'), (2, "u", "nothing")], "page_id long, url string, html string")
    from pyspark.sql import functions as F

    rows, over = feeds.once(feeds.portal_items(df), most=1)
    assert over.count() == 1
    got = {r.property_name: r for r in feeds.portal_records(rows, F.lit("City of X (BMR)")).collect()}
    a, b = got["Oak"], got["B"]
    assert (a.bedrooms, a.listing_status, a.address, a.confidence) == ("Studio (30% AMI), 1BR (50–60% AMI)", "waitlist", "1 Elm, X, CA 9", "high")
    assert a.notes == "closed — not currently accepting applications; waitlist open (3 spots); due: 2025-01-02; app fee: $10"
    assert a.document_url == "https://p.example/listings/7/oak" and b.bedrooms == "2 of 9 units" and b.source == "bloom"


def test_map_layers(spark):
    body = 'var x = {"features":[{"properties":{"Name":"Oak","units":"5"},"geometry":{"type":"Point","coordinates":[-122.123456,37.5]}},{"properties":{},"geometry":null}]};'
    got = feeds.geo_records(spark.createDataFrame([("City of X", "u", body), ("Y", "u", "no json")], "authority string, url string, body string")).collect()
    assert [r.property_name for r in got] == ["Oak", "Property"] and got[0].notes.endswith("approx lat/lon: 37.50000, -122.12346") and got[0].source == "gis:city_of_x"
    body = '{"features":[{"attributes":{"NAME":"Elm","units":"Null","PhoneNumber":"5","Agency":"M","AMI":"60"}},{"attributes":{"units":"3"}}]}'
    got = feeds.map_records(spark.createDataFrame([("X", "u", body)], "authority string, url string, body string")).collect()
    assert [(r.property_name, r.unit_types, r.phone, r.administrator) for r in got] == [("Elm", "", "5", "M")]
    assert got[0].notes == "Source: municipal ArcGIS layer | Income level: 60 | Manager: M"
    rest = spark.createDataFrame([("u", '[{"id":"1","link":"l","title":{"rendered":"A &amp; B"},"city":["9","3"]}]')], "url string, body string")
    assert [tuple(r) for r in feeds.rest_records(rest, {"3": "X"}).collect()] == [("A & B", "l", "X, CA")]


PAGES = {"https://a.example": [(["1", "2"], True), (["3"], False)], "https://b.example": [(["1"], True), ([], True)], "https://a.example/2": [(["9"], True)] * 9}


def fetch(url, n):
    return PAGES[url][n - 1]


def test_paged_source(spark):
    assert feeds.walk_pages(lambda n: (["x"], True), 3) == (["x"] * 3, "more than 3 pages")
    rows = feeds.read_paged(spark, list(PAGES), "tests.test_sources:fetch", most=4).collect()
    items = {u: [r.item for r in rows if r.url == u and r.item] for u in PAGES}
    assert items == {"https://a.example": ["1", "2", "3"], "https://b.example": ["1"], "https://a.example/2": ["9"] * 4}
    assert {r.url: r.had_error for r in rows if r.item is None} == {"https://a.example": False, "https://b.example": True, "https://a.example/2": True}


def test_documents(spark):
    text = "Oak Creek Senior, 12 Elm Street, (408) 555-1234 a@b.example\nshort\n\n  nothing here at all  \n"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "k long, t string")
    lines = docs.lines_of(df, "k", "t")
    assert lines.count() == 3
    r = docs.line_records(lines, "k").collect()
    assert [(x.property_name, x.address, x.phone, x.email, x.community_type, x.confidence) for x in r] == [("Oak Creek Senior", "12 Elm Street", "(408) 555-1234", "a@b.example", "senior", "high")]
    flyer = docs.flyer_record(df, "k", "t").where("k = 1").first()
    assert flyer.address == "12 Elm Street" and docs.flyer_record(df, "k", "t").count() == 3
    cells = spark.createDataFrame([(1, 0, ["x"]), (1, 1, ["Apartment Complex", "Phone", "Property Manager"]), (1, 2, ["Oak", "", "M"]), (1, 3, ["Elm", "(408) 555-1234", ""]), (1, 4, ["z", "", ""])], "k long, n int, cells array<string>")
    t = {r.n: (dict(r.fields), r.confidence) for r in docs.table_records(cells, "k").collect()}
    assert t == {2: ({"property_name": "Oak", "property_manager": "M"}, "low"), 3: ({"property_name": "Elm", "phone": "(408) 555-1234"}, "low")}
    marked = spark.createDataFrame([(1, "# head\n| a | long enough cell |\n" + "-" * 50 + "\n* a bullet that is long")], "k long, t string")
    assert [(r.page, r.line) for r in docs.marked_lines(marked, "k", "t").orderBy("page").collect()] == [(0, "a long enough cell"), (1, "a bullet that is long")]
    directory = "BMR list\nOak Homes     Elm Homes\n1 Elm St, Gilroy, CA 95020    2 Oak St, Gilroy, CA\n(408) 555-1234   (408) 555-9999\na@b.example\nFir Homes - coming soon\n"
    d = docs.directory_records(spark.createDataFrame([(1, directory, "https://x.example/d.pdf#p")], "k long, t string, u string"), "k", "t", "u").orderBy("seq").collect()
    assert [(r.property_name, r.phone, r.url) for r in d] == [
        ("Oak Homes", "(408) 555-1234", "https://x.example/d.pdf#oak-homes"), ("Elm Homes", "(408) 555-9999", "https://x.example/d.pdf#elm-homes"), ("Fir Homes", "", "https://x.example/d.pdf#fir-homes"),
    ]
    tiers = spark.createDataFrame([(1, 2, "high"), (1, 1, "low"), (2, 1, "medium"), (2, 2, "high")], "k long, tier int, confidence string")
    assert sorted((r.k, r.tier) for r in docs.best_tier(tiers, "k").collect()) == [(1, 2), (2, 1)]
    pdf = spark.createDataFrame([(bytearray(b"  %PDF-1.4"), ""), (bytearray(b"<html>"), "application/pdf"), (bytearray(b"xx"), "application/PDF")], "b binary, c string")
    from pyspark.sql import functions as F

    assert [r[0] for r in pdf.select(docs.is_pdf(F.col("b"), F.col("c"))).collect()] == [True, False, True]


def test_every_line_and_card_whatever_its_signs(spark, tmp_path):
    texts = [None, "", " 　 ", "plain  ascii\r\n\n x", "Danh sách chờ  mở\n候补　名单", "“List” — 5½ weeks\n \n🏠 Oak", "Приём\tзаявлений"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    wanted = sorted((i, n, " ".join(line.split())) for i, t in enumerate(texts) for n, line in enumerate(re.split(r"\r?\n", t or "")) if line.split())
    assert sorted((r.doc_id, r.n, r.line) for r in catalog.QUERIES["document_lines"](spark, str(tmp_path)).collect()) == wanted
    names = [None, "", "  ", "Oak  House", "Peña Court", "“Elm” — <Homes>", "候补"]
    spark.createDataFrame([(i, n, n) for i, n in enumerate(names)], "row_id long, property_name string, address string").write.parquet(f"{tmp_path}/mirror_records.parquet")
    wanted = sorted((i, " ".join(n.split()), f"https://x.example/p/{i}", " ".join(n.split())) for i, n in enumerate(names) if n and n.split())
    assert sorted(tuple(r) for r in catalog.QUERIES["mirror_cards"](spark, str(tmp_path)).collect()) == wanted
