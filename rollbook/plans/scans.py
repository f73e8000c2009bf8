"""Queries of composed scans and of report parts over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions import text as X
from rollbook.operators import changes, report, signals
from rollbook.plans import reference as ref
from rollbook.session import table
from rollbook.sources import documents as docs
from rollbook.sources import feeds, pages, scans

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str):
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _html(text):
    out = text
    for sign, mark in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(sign), F.lit(mark))
    return out


@query(
    f"""SELECT partner_id, names[i] AS name, parts[i] AS value FROM (
    SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT partner_id, ['project_name', 'street_address', 'unit_phone'] AS names,
      list_filter([{ref._clean_sql('building_name')}, {ref._clean_sql('street_address')}, {ref._clean_sql('leasing_phone')}], lambda x: x <> '') AS parts FROM partner_listings))"""
)
def table_cells(spark, directory):
    """Cells of HTML tables made of partner listings, under their cleaned headers; empty cells are left out first."""
    p = table(spark, directory, "partner_listings")
    cells = [F.concat(F.lit("<td>"), _html(X.said(F.col(c))), F.lit("</td>")) for c in ("building_name", "street_address", "leasing_phone")]
    html = F.concat(F.lit("<table><tr><th>Project Name, Street/Address</th><th></th><th>Unit. Phone</th></tr><tr>").cast("string"), *cells, F.lit("</tr></table>"))
    html = F.replace(html, F.lit("Street/Address"), F.lit("Street Address"))
    site = p.select(F.col("partner_id").alias("page_id"), F.lit("https://x.example/t").alias("url"), html.alias("html"))
    return pages.table_rows(site).select(F.col("page_id").alias("partner_id"), F.explode("cells").alias("name", "value"))


@query(
    """SELECT p_partkey AS page_id, 'https://x.example/DocumentCenter/View/' || p_partkey || '/' || replace(p_type, ' ', '-') AS href, p_type AS name FROM part WHERE p_partkey % 3 <> 0"""
)
def flyer_links(spark, directory):
    """Flyers of availability pages with their property: from the text around, or the link's own words."""
    p = table(spark, directory, "part")
    link = F.concat(F.lit('<a href="/DocumentCenter/View/'), F.col("p_partkey").cast("string"), F.lit("/"), F.replace("p_type", F.lit(" "), F.lit("-")), F.lit('">'))
    label = F.when(F.col("p_partkey") % 3 == 0, "Meeting").otherwise("Official Flyer 50%AMI")
    around = F.when(F.col("p_partkey") % 3 == 1, F.concat("p_type", F.lit(" - 3 available units"))).otherwise("")
    html = F.concat(F.lit("<ul><li><strong>"), around, F.lit("</strong><p>"), link, label, F.lit("</a></p></li></ul>"))
    site = p.select(F.col("p_partkey").alias("page_id"), F.lit("https://x.example/list").alias("url"), html.alias("html"))
    return scans.flyer_links(pages.links(site)).select("page_id", "href", "name")


_LINK_SQL = "'https://' || CASE p_partkey % 4 WHEN 0 THEN 'x.example/gis/' || p_brand WHEN 1 THEN 'docs.x.example/units/' || p_type || '.pdf' WHEN 2 THEN 'y.example/flyer/' || p_brand || '.pdf' ELSE 'x.example/flyer/' || p_name || '.pdf' END"


def _links(spark, directory) -> DataFrame:
    p = table(spark, directory, "part")
    k = F.col("p_partkey") % 4
    tail = (
        F.when(k == 0, F.concat(F.lit("x.example/gis/"), "p_brand"))
        .when(k == 1, F.concat(F.lit("docs.x.example/units/"), "p_type", F.lit(".pdf")))
        .when(k == 2, F.concat(F.lit("y.example/flyer/"), "p_brand", F.lit(".pdf")))
        .otherwise(F.concat(F.lit("x.example/flyer/"), "p_name", F.lit(".pdf")))
    )
    return p.select(
        F.col("p_size").alias("page_id"), F.col("p_partkey").alias("seq"), F.replace(F.concat(F.lit("https://"), tail), F.lit(" "), F.lit("-")).alias("href"), F.lit("").alias("label")
    )


_FOUND_SQL = f"WITH f AS (SELECT p_size AS page_id, p_partkey AS seq, replace({_LINK_SQL}, ' ', '-') AS href FROM part)"


@query(
    _FOUND_SQL
    + """, g AS (SELECT page_id, href, min(seq) AS seq FROM f WHERE regexp_matches(lower(href), 'units|bmr|rentals|portfolio|gis|features|geojson') GROUP BY 1, 2)
    SELECT * FROM (SELECT page_id, href, row_number() OVER (PARTITION BY page_id ORDER BY seq)::INTEGER AS nth FROM g) WHERE nth <= 8"""
)
def map_candidates(spark, directory):
    """The first links of each page that may lead to map data."""
    return scans.map_links(_links(spark, directory))


@query(_FOUND_SQL + " SELECT page_id, href, min(seq) AS seq FROM f WHERE contains(lower(href), '.pdf') AND (href LIKE 'https://x.example/%' OR href LIKE 'https://docs.x.example/%') GROUP BY 1, 2")
def document_links(spark, directory):
    """Links to documents on the page's own site, each once."""
    found = _links(spark, directory)
    site = found.select("page_id", F.lit("https://x.example/list").alias("url")).distinct()
    return scans.document_links(found, site).select("page_id", "href", "seq")


@query(
    _FOUND_SQL
    + f""", g AS (SELECT page_id, href, min(seq) AS seq FROM f WHERE regexp_matches(lower(href), '{pages.DOCUMENT_HINTS.replace(".", chr(92) + ".")}') AND NOT regexp_matches(lower(href), '{pages.NOISE_HINTS}') GROUP BY 1, 2)
    SELECT page_id, href, row_number() OVER (PARTITION BY page_id ORDER BY regexp_matches(lower(href), '{pages.FLYER_HINTS}') DESC, seq)::INTEGER AS nth,
      nth <= {pages.DOCUMENT_BUDGET} AS within_budget FROM g"""
)
def document_budget(spark, directory):
    """Documents of each page in reading order, flyers first, with what lies beyond the budget marked."""
    return pages.documents_to_read(_links(spark, directory))


@query(
    """WITH c AS (SELECT c_custkey AS page_id, CASE WHEN c_custkey % 2 = 0 THEN '1-urgent' ELSE '' END AS city FROM customer),
    i AS (SELECT o_custkey AS page_id, o_orderkey, o_orderpriority AS own, CASE WHEN o_custkey % 3 = 0 THEN 'page' WHEN o_custkey % 3 = 1 THEN 'service' END AS path FROM orders),
    w AS (SELECT c.*, CASE WHEN page_id % 3 = 0 AND page_id IN (SELECT page_id FROM i) THEN 'page'
      WHEN page_id % 3 = 1 AND page_id IN (SELECT page_id FROM i) OR page_id % 7 = 0 THEN 'service' ELSE 'empty' END AS path FROM c),
    n AS (SELECT w.page_id, count(i.page_id)::BIGINT AS n FROM w JOIN i ON i.page_id = w.page_id AND i.path = w.path AND (city = '' OR lower(own) = city) GROUP BY 1)
    SELECT page_id, path, least(coalesce(n, 0), 5)::BIGINT AS n, CASE WHEN path = 'service' AND page_id % 7 = 0 THEN 'incomplete' WHEN n > 5 THEN 'truncated' WHEN coalesce(n, 0) = 0 THEN 'empty' END AS error_kind,
      error_kind IS NOT NULL AS had_error FROM w LEFT JOIN n USING (page_id)"""
)
def portal_ways(spark, directory):
    """How each portal ended: by its page, its service, or with nothing; customers stand for portals, orders for listings."""
    o, c = table(spark, directory, "orders"), table(spark, directory, "customer")
    body = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("id"), F.struct(F.col("o_orderpriority").alias("city")).alias("listingsBuildingAddress")))
    items = o.select(F.col("o_custkey").alias("page_id"), F.lit("https://p.example/l").alias("url"), F.col("o_orderkey").cast("int").alias("rank"), F.from_json(body, feeds.ITEM).alias("item"))
    portals = c.select(F.col("c_custkey").alias("page_id"), F.when(F.col("c_custkey") % 2 == 0, "1-urgent").otherwise("").alias("city"))
    service = c.select(F.col("c_custkey").alias("page_id"), (F.col("c_custkey") % 7 != 0).alias("complete"))
    rows, ended = scans.portal_inventory(portals, items.where("page_id % 3 = 0"), items.where("page_id % 3 = 1"), service, most=5)
    told = rows.groupBy("page_id").agg(F.count("*").alias("m"))
    return ended.drop("n").join(told, "page_id", "left").select("page_id", "path", F.coalesce("m", F.lit(0)).alias("n"), "had_error", "error_kind")


@query("SELECT ref_id, trim(regexp_replace(regexp_replace(authority, '\\s*\\([^)]*\\)\\s*$', ''), '^\\s*(City|Town) of\\s+', '')) AS city FROM ref_authorities")
def city_names(spark, directory):
    """City that each authority's label names."""
    return table(spark, directory, "ref_authorities").select("ref_id", scans.city_of(F.col("authority")).alias("city"))


@query(
    """WITH k AS (SELECT p_partkey, list_filter(['id', CASE WHEN p_partkey % 2 = 0 THEN 'Name' END, CASE WHEN p_partkey % 3 = 0 THEN 'bedrooms' END, CASE WHEN p_partkey % 11 = 0 THEN 'buildId' END,
      CASE WHEN p_partkey % 5 = 0 THEN 'enableA' END, CASE WHEN p_partkey % 5 = 0 THEN 'showB' END, CASE WHEN p_partkey % 10 = 0 THEN 'limitC' END, CASE WHEN p_partkey % 20 = 0 THEN 'allowD' END], lambda x: x IS NOT NULL) AS keys FROM part)
    SELECT p_partkey, p_partkey % 20 <> 0 AND p_partkey % 11 <> 0 AND (p_partkey % 2 = 0 OR p_partkey % 3 = 0) AS listing FROM k"""
)
def listing_objects(spark, directory):
    """Which objects of a page's data are listings, by their keys."""
    k = F.col("p_partkey")
    told = (("Name", 2), ("bedrooms", 3), ("buildId", 11), ("enableA", 5), ("showB", 5), ("limitC", 10), ("allowD", 20))
    keys = F.filter(F.array(F.lit("id"), *[F.when(k % n == 0, name) for name, n in told]), lambda x: x.isNotNull())
    return table(spark, directory, "part").select("p_partkey", scans.looks_like_listing(keys).alias("listing"))


@query(
    f"""WITH l AS ({ref.SQL['text_lines']})
    SELECT doc_id, n FROM l WHERE len(list_filter([{', '.join(f"'{w}'" for w in docs.HEADER_WORDS)}], lambda w: contains(lower(line), w))) >= 2"""
)
def header_lines(spark, directory):
    """Lines of texts that read like the header of a table."""
    lines = docs.lines_of(table(spark, directory, "documents"), "doc_id", "text")
    return lines.where(scans.looks_like_header(F.split("line", " "))).select("doc_id", "n")


@query(
    """WITH u AS (SELECT l_orderkey, l_linenumber - 1 AS beds, (l_quantity::INTEGER % 4 * 10 + 30)::VARCHAR AS ami FROM lineitem),
    g AS (SELECT l_orderkey, beds, list_sort(list_distinct(list(ami))) AS levels FROM u GROUP BY 1, 2)
    SELECT l_orderkey, string_agg(CASE WHEN beds = 0 THEN 'Studio' ELSE beds || 'BR' END || ' (' || array_to_string(levels, '–') || '% AMI)', ', ' ORDER BY beds) AS units FROM g GROUP BY 1"""
)
def unit_summaries(spark, directory):
    """Bedroom counts with their income levels; lines of orders stand for units."""
    units = F.collect_list(F.struct((F.col("l_linenumber") - 1).cast("int").alias("numBedrooms"), (F.col("l_quantity").cast("int") % 4 * 10 + 30).cast("string").alias("amiPercentage"), F.lit(None).cast("string").alias("monthlyRent")))
    grouped = table(spark, directory, "lineitem").groupBy("l_orderkey").agg(units.alias("units"))
    return grouped.select("l_orderkey", feeds.unit_summary(F.from_json(F.to_json("units"), f"array<{feeds.UNIT}>")).alias("units"))


@query(
    """SELECT s_suppkey, s_name AS property_name, 'https://s.example/' || s_suppkey AS url, CASE s_nationkey % 3 WHEN 0 THEN 'Gilroy, CA' WHEN 1 THEN 'Napa, CA' ELSE '' END AS address FROM supplier"""
)
def service_titles(spark, directory):
    """Records of a content service: titles unescaped, the first known city named."""
    s = table(spark, directory, "supplier")
    item = F.struct(
        F.col("s_suppkey").cast("string").alias("id"), F.concat(F.lit("https://s.example/"), F.col("s_suppkey").cast("string")).alias("link"),
        F.struct(F.col("s_name").alias("rendered")).alias("title"), F.array(F.lit("none"), F.concat(F.lit("c"), (F.col("s_nationkey") % 3).cast("string"))).alias("city"),
    )
    out = feeds.rest_records(s.select(F.lit("https://s.example").alias("url"), F.to_json(F.array(item)).alias("body")), {"c0": "Gilroy", "c1": "Napa"})
    return out.select(F.substring_index("url", "/", -1).cast("long").alias("s_suppkey"), "property_name", "url", "address")


@query("SELECT c_custkey, c_name AS property_name, c_mktsegment AS administrator, 'Source: municipal ArcGIS layer | Manager: ' || c_mktsegment AS notes FROM customer")
def map_service(spark, directory):
    """Records of a map service's features, whatever the case of their attributes."""
    c = table(spark, directory, "customer")
    made = F.create_map(F.lit("NAME"), F.col("c_name"), F.lit("agency"), F.col("c_mktsegment"), F.lit("Phone"), F.lit("Null"), F.lit("Website"), F.col("c_custkey").cast("string"))
    body = F.to_json(F.struct(F.array(F.struct(made.alias("attributes"))).alias("features")))
    out = feeds.map_records(c.select(F.lit("City").alias("authority"), F.lit("https://m.example").alias("url"), body.alias("body")))
    return out.select(F.col("url").cast("long").alias("c_custkey"), "property_name", "administrator", "notes")


@query(
    f"""SELECT run_id, count(*)::BIGINT AS n FROM inventory_snapshots WHERE {ref._KIND_SQL} = 'property' AND NOT contains(lower(coalesce(property_name, '')), 'closed')
    AND NOT regexp_matches(lower(coalesce(property_name, '')), '^({"|".join(report.NAVIGATION)})') AND (contains(coalesce(source, ''), ':') OR length(property_name) > 4) GROUP BY 1"""
)
def summary_counts(spark, directory):
    """How many rows of each run a summary may list."""
    return report.summary_candidates(ref._snapshot_rows(spark, directory)).groupBy("run_id").agg(F.count("*").alias("n"))


@query(
    ref._SIGNAL_SQL
    + """, o AS (SELECT authority, min(CASE WHEN failed THEN 0 WHEN signal = 'low_yield' THEN 1 ELSE 2 END) AS told FROM s WHERE failed OR signal IN ('suspicious_zero', 'low_yield') GROUP BY 1)
    SELECT authority, row_number() OVER (ORDER BY told, authority)::INTEGER AS nth FROM o"""
)
def unreliable_order(spark, directory):
    """Sources whose missing rows say nothing, in the order they are told."""
    return signals.unreliable_in_order(ref._signals(spark, directory))


def _labelled(spark, directory) -> DataFrame:
    return changes.classify(ref._event_inventory(spark, directory), ref._event_runs(spark, directory)[0], ref._failed(spark))


@query(ref._INV_SQL + " SELECT authority, property_name, '' AS url, change_type FROM l")
def rekeyed_diff(spark, directory):
    """Rows of a change export under the inventory's key."""
    out = _labelled(spark, directory).select(F.col("authority").alias("source_authority"), "property_name", "url", "change_type")
    return report.rekeyed(out)


@query(ref._INV_SQL + " SELECT authority, count(*) FILTER (change_type = 'STALE')::BIGINT AS stale, count(*) FILTER (change_type = 'SCRAPE_FAILED')::BIGINT AS failed FROM l GROUP BY 1")
def prune_proposal(spark, directory):
    """What pruning after a run could take, by source."""
    return report.prune_proposal(_labelled(spark, directory))


@query(
    ref._INV_SQL + """ SELECT CASE WHEN change_type = 'NEW' THEN 'ADDED' WHEN change_type = 'SCRAPE_FAILED' THEN 'SCRAPE_FAILED' WHEN last_run_id = before THEN 'REMOVED' ELSE 'STALE' END AS change_type,
    authority, property_name, '' AS url, '' AS details FROM l, d WHERE change_type <> 'UPDATED'""".replace("FROM l, d", "FROM l")
)
def changelog_file(spark, directory):
    """Rows of the change log's file."""
    none = spark.createDataFrame([], "authority string, property_name string, url string, status string, listing_status string")
    events = changes.staff_events(_labelled(spark, directory), ref._event_runs(spark, directory)[1], ref._failed(spark), none, none)
    return report.changelog_csv(events)


# ---- Pages of each kind, made of parts --------------------------------------------------------------------------


def _made(spark, directory, kind: str, template: str, fields: str) -> DataFrame:
    """Pages of one kind from a template, ``{n}`` the part's number and ``{t}`` its type, read back: ``page_id`` and the fields."""
    html = F.lit(template)
    for mark, value in (("{n}", F.col("p_partkey").cast("string")), ("{t}", F.col("p_type"))):
        html = F.replace(html, F.lit(mark), value)
    site = table(spark, directory, "part").select(F.col("p_partkey").alias("page_id"), F.lit("https://x.example/list").alias("url"), html.alias("html"))
    out = pages.page_records(site, kind)
    return out.select("page_id", *[F.col("record")[c].alias(c) for c in fields.split()])


@query("SELECT p_partkey AS page_id, p_type AS property_name, p_partkey || ' available' AS unit_types, '(408) 555-1234' AS phone FROM part")
def availability_pages(spark, directory):
    """Availability lists."""
    return _made(
        spark, directory, "availability", '<ul role="presentation"><li><strong>{t} - {n} available units</strong> call (408) 555-1234</li></ul>', "property_name unit_types phone"
    )


@query("SELECT p_partkey AS page_id, p_type AS property_name, 'https://x.example/p' || p_partkey AS url, p_partkey || ' Elm St, X, CA' AS address, 'm' || p_partkey || '@b.example' AS email, '555-1' AS phone, 'Studio' AS unit_types FROM part")
def contact_pages(spark, directory):
    """Cards with contacts."""
    card = '<div class="h_apart_ctc"><a href="/p{n}">{t}</a><a href="javascript:;">{n} Elm St, X, CA, USA</a><a href="mailto:m{n}@b.example">m</a><a href="tel:555">555-1</a><span class="unit-type">Studio</span></div>'
    return _made(spark, directory, "charities_housing", card, "property_name url address email phone unit_types")


@query("SELECT p_partkey AS page_id, p_type AS property_name, 'https://x.example/property/p' || p_partkey AS url, 'waitlist' AS listing_status, 'Campbell, CA' AS address, 'senior' AS eligibility_flags FROM part")
def location_pages(spark, directory):
    """Cards of locations; one with two links is no property."""
    card = (
        '<div class="elementor-location-single"><a href="/property/p{n}"><img></a><a href="/property/p{n}">{t}</a><p>Senior, Wait list open. Campbell, CA</p></div>'
        '<div class="elementor-location-single"><a href="/property/a">A</a><a href="/property/b">B</a></div>'
    )
    return _made(spark, directory, "midpen", card, "property_name url listing_status address eligibility_flags")


@query("SELECT p_partkey AS page_id, p_type AS property_name, 'https://x.example/p' || p_partkey AS url, 'closed' AS listing_status, 'Hayward, CA' AS address, p_partkey || ' units' AS unit_types FROM part")
def grid_pages(spark, directory):
    """Grids of badge and title links."""
    card = '<ul><li><a href="/p{n}">Closed</a><a href="/p{n}">{t}</a> Hayward, California {n} units</li></ul>'
    return _made(spark, directory, "eden", card, "property_name url listing_status address unit_types")


@query("SELECT p_partkey AS page_id, p_type AS property_name, 'https://x.example/p' || p_partkey AS url, p_partkey || ' Elm St, Gilroy, CA 95020' AS address, 'Gilroy' AS city FROM part")
def heading_pages(spark, directory):
    """Lists of headings with addresses."""
    return _made(spark, directory, "eah", '<ul><li><h2><a href="/p{n}">{t}</a></h2><p>{n} Elm St, Gilroy, California 95020</p></li></ul>', "property_name url address city")


@query("SELECT p_partkey AS page_id, p_type AS property_name, p_partkey || ' units' AS unit_types, '12 Elm Street, San Jose, CA 95110' AS address, 'family' AS eligibility_flags, 'open' AS listing_status FROM part")
def box_pages(spark, directory):
    """Boxes under headings."""
    card = '<div class="property-box"><h3>{t}</h3>12 Elm Street, San Jose, CA 95110 <p>{n} units for Family, open</p></div>'
    return _made(spark, directory, "scc_boxes", card, "property_name unit_types address eligibility_flags listing_status")


@query("SELECT p_partkey AS page_id, p_type AS property_name, p_partkey || ' Elm St' AS address, '555-' || p_partkey AS phone, 'open' AS status, 'https://x.example/f' || p_partkey || '.pdf' AS notes FROM part")
def labelled_pages(spark, directory):
    """Pages of one property with labelled lines."""
    card = '<h1>{t}</h1><p>Address: {n} Elm St</p><p>Phone: 555-{n}</p><p>Status: open</p><a href="f{n}.pdf">more</a>'
    return _made(spark, directory, "labelled", card, "property_name address phone status notes")


_COMMUNITY_SQL = "CASE " + " ".join(f"WHEN contains(lower(line), '{c}') THEN '{c}'" for c in sorted(docs.COMMUNITIES, key=lambda c: (-len(c), c))) + " END"


def line_records_sql() -> str:
    """Records of lines, told from the lines' own SQL."""
    found = [p.replace("'", "''") for p in (docs.PHONE, docs.EMAIL, docs.ADDRESS)]
    return f"""WITH l AS ({ref.SQL['text_lines']}),
    f AS (SELECT doc_id, n, line, {', '.join(f"regexp_extract(line, '({p})', 1) AS {c}" for p, c in zip(found, ('phone', 'email', 'address')))} FROM l WHERE length(line) >= {docs.LINE_LEAST}),
    g AS (SELECT *, regexp_replace(trim(split_part(line, CASE WHEN address <> '' THEN address WHEN phone <> '' THEN phone ELSE email END, 1)), '[\\s,;:–-]+$', '') AS property_name,
      {_COMMUNITY_SQL} AS community_type FROM f WHERE phone <> '' OR email <> '' OR address <> ''),
    s AS (SELECT *, (phone <> '')::INT + (email <> '')::INT + (address <> '')::INT + (property_name <> '')::INT + (community_type IS NOT NULL)::INT AS signals FROM g)
    SELECT doc_id, (n)::INTEGER AS n, property_name, address, phone, email, community_type, CASE WHEN signals >= 4 THEN 'high' WHEN signals >= 2 THEN 'medium' ELSE 'low' END AS confidence FROM s"""


SQL["line_records"] = line_records_sql()
