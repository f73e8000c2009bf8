"""Queries of the inventory operators over the driver's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.functions import text as X
from rollbook.operators import canonical, changes, report, resolve, signals
from rollbook.operators import inventory as inv
from rollbook.session import table
from rollbook.sources import documents as docs
from rollbook.sources import feeds, pages, registry
from rollbook.streaming.runs import windowed_counts

NOW = "2025-06-15T00:00:00"
TODAY = "2025-06-15"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


#: White space of Unicode as DuckDB's patterns need it.
_BLANK = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

# ---- SQL of the shared expressions -------------------------------------------------------------------------------


def _name_key_sql(v: str) -> str:
    names = ", ".join(f"'{s}'" for s in X.NAME_SUFFIXES)
    return (
        f"regexp_replace(list_reduce(list_prepend(lower(coalesce({v}, '')), [{names}]), lambda a, x: CASE WHEN ends_with(a, x)"
        f" THEN substr(a, 1, length(a) - length(x)) ELSE replace(a, x, ' ') END), '[^a-z0-9]', '', 'g')"
    )


def _address_key_sql(v: str) -> str:
    t = f"lower(coalesce({v}, ''))"
    for words, short in X.STREET_FORMS:
        t = f"regexp_replace({t}, '\\b({words})\\b', '{short}', 'g')"
    pattern = "'(\\d{1,6})\\s+([a-z][a-z0-9\\-\\s]{0,40})'"
    street = f"substr(regexp_replace(regexp_extract({t}, {pattern}, 2), '[^a-z0-9]', '', 'g'), 1, 25)"
    return (
        f"CASE WHEN regexp_extract({t}, {pattern}, 1) <> '' AND {street} <> '' THEN regexp_extract({t}, {pattern}, 1) || {street}"
        f" ELSE substr(regexp_replace({t}, '[^a-z0-9]', '', 'g'), 1, 40) END"
    )


def _strip(v: str) -> str:
    return f"regexp_replace(coalesce({v}, ''), '^\\s+|\\s+$', '', 'g')"


def _label_sql(v: str) -> str:
    s = _strip(v)
    return (
        f"CASE WHEN lower({s}) LIKE 'john stewart%' OR lower({s}) LIKE '%john stewart company%' THEN 'John Stewart Company'"
        f" WHEN lower({s}) LIKE '%sccha%' OR lower({s}) LIKE '%santa clara county housing authority%' THEN 'Santa Clara County Housing Authority'"
        f" WHEN lower({s}) LIKE '%housing group%' THEN 'Housing Group' WHEN lower({s}) LIKE '%midpen%' THEN 'MidPen Housing'"
        f" WHEN lower({s}) LIKE '%charities housing%' THEN 'Charities Housing' WHEN lower({s}) LIKE '%eden housing%' THEN 'Eden Housing'"
        f" WHEN lower({s}) LIKE '%eah housing%' OR regexp_extract(lower({s}), '^\\S+') = 'eah' THEN 'EAH Housing' ELSE {s} END"
    )


_STATUS_SQL = (
    f"coalesce(CASE lower({_strip('listing_status')}) WHEN 'open' THEN 'Open' WHEN 'waitlist' THEN 'Waitlist' WHEN 'coming_soon' THEN 'Coming Soon'"
    f" WHEN 'closed' THEN 'Closed' END, nullif({_strip('status')}, ''), 'Unknown')"
)
_ADDRESS = _address_key_sql("trim(address)")
_LINK_SQL = (
    f"CASE WHEN {_strip('url')} <> '' THEN {_strip('url')}"
    f" WHEN length({_ADDRESS}) >= 6 AND regexp_matches({_ADDRESS}, '[0-9]') THEN 'roll:addr:' || {_ADDRESS}"
    f" WHEN {_strip('source_url')} <> '' AND {_strip('property_name')} <> '' THEN 'roll:src:' || slug || ':' || digest"
    f" WHEN {_strip('property_name')} <> '' THEN 'roll:prop:' || slug || ':' || digest WHEN slug <> '' THEN 'roll:prop:' || slug || ':unknown' ELSE '' END"
)
_RAW_SQL = f"""
WITH told AS (
  SELECT *, substr(regexp_replace(lower({_label_sql('authority')}), '[^a-z0-9]', '', 'g'), 1, 20) AS slug,
    substr(sha256({_strip('property_name')} || CASE WHEN {_strip('address')} <> '' THEN ':' || substr({_address_key_sql(_strip('address'))}, 1, 15) ELSE '' END
      || CASE WHEN {_strip('source_url')} <> '' THEN ':' || right({_strip('source_url')}, 20) ELSE '' END), 1, 8) AS digest FROM raw_records),
rows AS (
  SELECT record_id AS seq, {_label_sql('authority')} AS authority, {_strip('property_name')} AS property_name, {_LINK_SQL} AS url,
    {_strip('address')} AS address, {_strip('phone')} AS phone, {_strip('email')} AS email, {_strip('confidence')} AS confidence,
    {_STATUS_SQL} AS status, lower({_strip('listing_status')}) AS listing_status,
    coalesce(array_to_string(eligibility_flags, '|'), '') AS eligibility_flags,
    {_strip("coalesce(nullif(unit_types, ''), bedrooms)")} AS unit_types,
    {', '.join(f"{_strip(c)} AS {c}" for c in ('deadline', 'bedrooms', 'income_limits', 'administrator', 'source', 'source_url', 'expires_at'))},
    coalesce(nullif(last_seen, ''), '{NOW}') AS last_seen, coalesce(nullif(first_seen, ''), '{NOW}') AS first_seen, '{NOW}' AS scrape_date,
    '' AS administrator_url, '' AS administrator_phone, '' AS administrator_contact,
    regexp_replace(concat_ws(' | ', {_strip('notes')}, CASE WHEN coalesce(address, '') <> '' AND NOT contains({_strip('notes')}, address) THEN 'addr: ' || address END,
      CASE WHEN coalesce(phone, '') <> '' THEN 'phone: ' || phone END, CASE WHEN coalesce(email, '') <> '' THEN 'email: ' || email END,
      CASE WHEN coalesce(bedrooms, '') <> '' THEN 'br: ' || bedrooms END), '^[ |]+|[ |]+$', '', 'g') AS notes
  FROM told)"""


def _raw(spark: SparkSession, directory: str) -> DataFrame:
    return canonical.canonical_rows(table(spark, directory, "raw_records").withColumn("seq", F.col("record_id")), NOW)


# ---- Canonical rows and keys ------------------------------------------------------------------------------------


@query(_RAW_SQL + " SELECT * FROM rows")
def canonical_listing(spark, directory):
    """Raw records as canonical rows."""
    return _raw(spark, directory)


@query(f"SELECT record_id, {_name_key_sql('property_name')} AS name_key, {_address_key_sql('address')} AS address_key, {_label_sql('authority')} AS label FROM raw_records")
def normal_keys(spark, directory):
    """Name key, address key and authority label of raw records."""
    return table(spark, directory, "raw_records").select(
        "record_id", X.name_key(F.col("property_name")).alias("name_key"), X.address_key(F.col("address")).alias("address_key"), X.authority_label(F.col("authority")).alias("label")
    )


_CROSS_SQL = (
    f"CASE WHEN url LIKE 'roll:addr:%' THEN 'url:' || url WHEN length({_address_key_sql('address')}) >= 6 AND regexp_matches({_address_key_sql('address')}, '[0-9]')"
    f" THEN 'addr:' || {_address_key_sql('address')} WHEN {_name_key_sql('property_name')} <> '' AND {_address_key_sql('address')} <> ''"
    f" THEN 'name_addr:' || {_name_key_sql('property_name')} || ':' || {_address_key_sql('address')} END"
)


@query(_RAW_SQL + f" SELECT seq, {_CROSS_SQL} AS cross_key FROM rows")
def cross_source_key(spark, directory):
    """Key of each raw record across sources."""
    return resolve.keyed(_raw(spark, directory)).select("seq", F.col("cross").alias("cross_key"))


@query(_RAW_SQL + " SELECT seq, authority, property_name FROM rows WHERE authority <> '' AND property_name <> ''")
def complete_rows(spark, directory):
    """Canonical rows with authority and name."""
    return canonical.complete(_raw(spark, directory)).select("seq", "authority", "property_name")


@query(
    "SELECT status, count(*)::BIGINT AS n FROM (SELECT " + _STATUS_SQL + " AS status FROM inventory_snapshots) GROUP BY 1"
)
def status_labels(spark, directory):
    """Rows of each status label."""
    rows = table(spark, directory, "inventory_snapshots")
    return rows.groupBy(X.status_label(F.col("listing_status"), F.col("status")).alias("status")).agg(F.count("*").alias("n"))


@query(
    """SELECT doc_id, CASE WHEN regexp_matches(t, '^[=+\\-@\\t\\r]') THEN '''' || t ELSE t END AS cell FROM (
    SELECT doc_id, coalesce(text, '') AS t FROM documents)"""
)
def csv_safe_cells(spark, directory):
    """Texts as cells no spreadsheet runs."""
    return table(spark, directory, "documents").select("doc_id", X.csv_safe(F.col("text")).alias("cell"))


@query(
    """SELECT authority, try_cast(nullif(regexp_extract(coalesce(validated_zero, ''), '(\\d{4}-\\d{2}-\\d{2})', 1), '') AS DATE) AS noted,
    try_cast(nullif(regexp_extract(coalesce(validated_zero_review_due, ''), '(\\d{4}-\\d{2}-\\d{2})', 1), '') AS DATE) AS due,
    CASE WHEN noted IS NULL OR due IS NULL THEN 'none' WHEN DATE '2025-06-15' <= due THEN 'current' ELSE 'due' END AS state FROM targets"""
)
def zero_states(spark, directory):
    """Noted zeros of sources and whether they still hold."""
    return table(spark, directory, "targets").select(
        "authority",
        X.iso_date(F.col("validated_zero")).alias("noted"),
        X.iso_date(F.col("validated_zero_review_due")).alias("due"),
        signals.zero_state(F.col("validated_zero"), F.col("validated_zero_review_due"), F.lit(TODAY).cast("date")).alias("state"),
    )


# ---- Sources ----------------------------------------------------------------------------------------------------

_TARGET_SQL = """
WITH t AS (SELECT *, list_filter(list_transform(string_split(lower(coalesce(scraping_measures, '')), ','), lambda m: CASE trim(m) WHEN 'cdn' THEN 'civicplus' ELSE trim(m) END),
  lambda m: m <> '') AS tags FROM targets)"""


@query(
    """SELECT authority, priority, row_number() OVER (ORDER BY priority DESC NULLS LAST, authority)::BIGINT AS nth FROM targets
    WHERE scraping_measures IS NULL OR scraping_measures NOT ILIKE '%no_public_list%'"""
)
def active_targets(spark, directory):
    """Sources to be read, in order."""
    order = Window.orderBy(F.col("priority").desc_nulls_last(), F.asc("authority"))  # sources are few
    return registry.active(table(spark, directory, "targets")).select("authority", "priority", F.row_number().over(order).cast("long").alias("nth"))


@query("SELECT authority FROM targets WHERE lower(authority) LIKE '%housing%' AND scraping_measures ILIKE '%no_public_list%'")
def skipped_targets(spark, directory):
    """Sources that are skipped, of a name part."""
    return registry.named(registry.skipped(table(spark, directory, "targets")), " HOUSING ").select("authority")


@query(
    f"""SELECT authority, url, substr(notes, 1, 800) AS notes, array_to_string(list_filter(string_split_regex(lower(coalesce(scraping_measures, '')), '[,; ]+'), lambda m: m <> ''), ',') AS measures
    FROM (SELECT authority, url, {_strip("regexp_replace(coalesce(notes, ''), '\\s+', ' ', 'g')")} AS notes, scraping_measures FROM targets)"""
)
def sanitized_targets(spark, directory):
    """Target rows cleaned."""
    return registry.sanitize(table(spark, directory, "targets")).select("authority", "url", "notes", F.col("scraping_measures").alias("measures"))


@query("SELECT authority, url, priority FROM targets")
def registry_table(spark, directory):
    """Targets written as a pipe table and read again."""
    t = table(spark, directory, "targets")
    cells = [F.replace(X.said(F.col(c)), F.lit("|"), F.lit("/")) for c in registry.TARGET]
    body = t.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"), (F.xxhash64("authority", "url") % 1000 + 2000).alias("n"))
    head = spark.createDataFrame([(f"| City/Authority | {' | '.join(h.title() for h in registry.HEADERS[1:])} |", -1)], "line string, n long")
    rows, _ = registry.parse_table(head.unionByName(body))
    return rows.select("authority", "url", F.when(F.col("priority") == "", None).otherwise(F.col("priority")).alias("priority"))


@query(
    _TARGET_SQL
    + f""" SELECT authority, (NOT list_has_any(tags, ['waf_blocked', 'no_public_list'])) AND list_has_any(tags, [{', '.join(f"'{x}'" for x in signals.INVENTORY)}]) AS expects FROM t"""
)
def expected_inventory(spark, directory):
    """Sources that should list properties."""
    return table(spark, directory, "targets").select("authority", signals.expects_inventory(X.measures(F.col("scraping_measures"))).alias("expects"))


@query(
    """SELECT doc_id, (lower(host) NOT IN ('localhost', 'metadata') AND host <> '' AND lower(host) NOT LIKE '%.local%' AND lower(host) NOT LIKE '%.internal%') AS allowed, href FROM (
    SELECT DISTINCT doc_id, href, regexp_extract(href, '^https?://([^/?#:]+)', 1) AS host FROM (
      SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), 'https?://[A-Za-z0-9./_-]+')) AS href FROM documents))"""
)
def allowed_links(spark, directory):
    """Links in texts and whether they may be fetched."""
    found = table(spark, directory, "documents").select("doc_id", F.explode(F.regexp_extract_all(X.said(F.col("text")), F.lit("(https?://[A-Za-z0-9./_-]+)"), F.lit(1))).alias("href"))
    return found.distinct().select("doc_id", X.url_allowed(F.col("href")).alias("allowed"), "href")


@query(
    f"""SELECT doc_id, (n - 1)::INTEGER AS n, line FROM (
    SELECT doc_id, generate_subscripts(parts, 1) AS n, regexp_replace(regexp_replace(unnest(parts), '{_BLANK}+', ' ', 'g'), '^ | $', '', 'g') AS line
    FROM (SELECT doc_id, string_split_regex(coalesce(text, ''), '\\r?\\n') AS parts FROM documents)) WHERE line <> ''"""
)
def text_lines(spark, directory):
    """Lines of texts, white space collapsed."""
    return docs.lines_of(table(spark, directory, "documents"), "doc_id", "text")


@query(SQL["text_lines"])
def document_lines(spark, directory):
    """The same lines, under the name of the source they are made for."""
    return docs.lines_of(table(spark, directory, "documents"), "doc_id", "text")


@query()
def line_records(spark, directory):
    """Contacts and addresses found in lines of texts."""
    return docs.line_records(docs.lines_of(table(spark, directory, "documents"), "doc_id", "text"), "doc_id")


@query()
def flyer_fields(spark, directory):
    """Fields of each text read as a flyer."""
    return docs.flyer_record(table(spark, directory, "documents"), "doc_id", "text")


def _escaped(c: str):
    out = X.said(F.col(c))
    for sign, mark in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(sign), F.lit(mark))
    return out


def _clean_sql(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{_BLANK}+', ' ', 'g'))"


def cards_of(mirror):
    """Directory cards made of mirror records, read back from HTML."""
    card = F.concat(
        F.lit('<div class="prop-box"><span class="prop-flag">Now Leasing</span><h3 class="prop-title"><a href="/p/'), F.col("row_id").cast("string"), F.lit('">'), _escaped("property_name"),
        F.lit('</a></h3><p class="block-desc">'), _escaped("address"), F.lit("</p></div>"),
    )
    html = mirror.select(F.col("row_id").alias("page_id"), F.lit("https://x.example/list").alias("url"), card.alias("html"))
    r = pages.page_records(html, "alta")
    return r.select(F.col("page_id").alias("row_id"), F.col("record")["property_name"].alias("property_name"), F.col("record")["url"].alias("url"), F.col("record")["address"].alias("address"))


@query(
    f"""SELECT row_id, {_clean_sql('property_name')} AS property_name, 'https://x.example/p/' || row_id AS url, nullif({_clean_sql('address')}, '') AS address FROM mirror_records
    WHERE {_clean_sql('property_name')} <> ''"""
)
def html_cards(spark, directory):
    """Directory cards of all named mirror records."""
    return cards_of(table(spark, directory, "mirror_records").where(X.stripped(F.col("property_name")) != ""))


@query(SQL["html_cards"])
def mirror_cards(spark, directory):
    """The same cards, under the name of the table they are made of."""
    return html_cards(spark, directory)


@query(
    """SELECT record_id, CASE WHEN trim(property_name) = '' THEN NULL ELSE regexp_replace(property_name, '^\\s+|\\s+$', '', 'g') END AS property_name,
    regexp_replace(coalesce(phone, ''), '^\\s+|\\s+$', '', 'g') AS phone, CASE lower(status) WHEN 'closed' THEN 'closed' ELSE 'open' END AS listing_status
    FROM (SELECT record_id, property_name, phone, CASE WHEN record_id % 3 = 0 THEN 'closed' ELSE 'active' END AS status FROM raw_records WHERE regexp_replace(coalesce(property_name, ''), '^\\s+|\\s+$', '', 'g') <> '')"""
)
def portal_feed(spark, directory):
    """Portal pages made of raw records, read back from their data script."""
    raw = table(spark, directory, "raw_records").where(X.stripped(F.col("property_name")) != "")
    item = F.struct(
        F.col("record_id").cast("string").alias("id"), F.col("property_name").alias("name"), F.when(F.col("record_id") % 3 == 0, "closed").otherwise("active").alias("status"),
        F.col("phone").alias("leasingAgentPhone"),
    )
    data = F.to_json(F.struct(F.struct(F.struct(F.array(item).alias("openListings")).alias("pageProps")).alias("props")))
    html = raw.select(
        F.col("record_id").alias("page_id"), F.lit("https://portal.example/listings").alias("url"),
        F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), data, F.lit("</script></html>")).alias("html"),
    )
    rows, _ = feeds.once(feeds.portal_items(html))
    out = feeds.portal_records(rows, F.lit("Portal"))
    return out.select(F.split("source", ":")[1].cast("long").alias("record_id"), "property_name", "phone", "listing_status")


@query(
    """SELECT partner_id, regexp_replace(coalesce(nullif(trim(building_name), ''), 'Property'), '^ +| +$', '', 'g') AS property_name,
    coalesce(units_available::VARCHAR, '') AS unit_types FROM partner_listings"""
)
def geo_layer(spark, directory):
    """A GeoJSON layer made of partner listings, read back out of a script."""
    p = table(spark, directory, "partner_listings")
    feature = F.struct(
        F.create_map(F.lit("Name"), X.said(F.col("building_name")), F.lit("units"), X.said(F.col("units_available").cast("string"))).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array(F.lit(-122.5), F.lit(37.25)).alias("coordinates")).alias("geometry"),
    )
    body = F.concat(F.lit("var layer = "), F.to_json(F.struct(F.array(feature).alias("features"))), F.lit(";"))
    layers = p.select(F.lit("City").alias("authority"), F.concat(F.lit("https://gis.example/"), F.col("partner_id").cast("string")).alias("url"), body.alias("body"))
    return feeds.geo_records(layers).select(F.substring_index("source_url", "/", -1).cast("long").alias("partner_id"), "property_name", "unit_types")


@query(
    "SELECT user_id, json_extract_string(props, '$.k') AS k, count(*)::BIGINT AS n FROM events GROUP BY 1, 2"
)
def json_properties(spark, directory):
    """Values of a JSON field of events."""
    e = table(spark, directory, "events").select("user_id", F.get_json_object("props", "$.k").alias("k"))
    return e.groupBy("user_id", "k").agg(F.count("*").alias("n"))


# ---- Duplicates -------------------------------------------------------------------------------------------------

_TRUST_SQL = "CASE confidence WHEN 'high' THEN 0.9 WHEN 'medium' THEN 0.7 WHEN 'low' THEN 0.4 ELSE 0.5 END"


def _doc_rows(spark, directory):
    """Documents as listings: the key across sources is a function of the row's own key."""
    d = table(spark, directory, "documents").where(F.trim(X.said(F.col("text"))) != "")
    h = F.sha2("text", 256)
    return d.select(
        F.col("source").alias("authority"), F.concat(F.lit("doc "), h).alias("property_name"), F.concat(F.lit("roll:addr:"), h).alias("url"), F.lit("").alias("address"),
        F.lit("").alias("phone"), F.lit("").alias("email"), F.when(F.col("lang") == "en", "high").otherwise("low").alias("confidence"), F.col("doc_id").alias("seq"),
    )


@query(
    """SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY CASE WHEN lang = 'en' THEN 0 ELSE 1 END, doc_id) AS n
    FROM documents WHERE trim(coalesce(text, '')) <> '') WHERE n = 1"""
)
def survivors_functional(spark, directory):
    """Documents without copies across sources, by two groupings."""
    return resolve.survivors(_doc_rows(spark, directory), "functional").select(F.col("seq").alias("doc_id"))


@query(SQL["survivors_functional"])
def survivors_rounds(spark, directory):
    """The same survivors by rounds of the exact two-key scan."""
    return resolve.survivors(_doc_rows(spark, directory), "exact").select(F.col("seq").alias("doc_id"))


@query(
    "WITH RECURSIVE"
    + _RAW_SQL.replace("WITH told", " told", 1)
    + f""", keyed AS (SELECT seq, authority, property_name, url, 'i' || concat_ws(chr(1), authority, property_name, url) AS ident, 'c' || {_CROSS_SQL} AS crossed,
    row_number() OVER (ORDER BY {_TRUST_SQL} DESC, (phone = '' AND email = '')::INT, (url = '')::INT, seq) AS n FROM rows WHERE authority <> '' AND property_name <> ''),
    scan AS (SELECT 0::BIGINT AS n, []::VARCHAR[] AS names, false AS keep
      UNION ALL SELECT k.n, CASE WHEN list_has_any(names, [ident, crossed]) THEN names ELSE list_concat(names, list_filter([ident, crossed], lambda x: x IS NOT NULL)) END, NOT list_has_any(names, [ident, crossed])
      FROM scan JOIN keyed k ON k.n = scan.n + 1)
    SELECT seq, authority, property_name, url FROM scan JOIN keyed USING (n) WHERE keep"""
)
def survivors_exact(spark, directory):
    """Raw records without cross-source duplicates, by the exact two-key scan."""
    return resolve.survivors(canonical.complete(_raw(spark, directory)), "exact").select("seq", "authority", "property_name", "url")


@query(
    """SELECT count(*)::BIGINT AS n FROM (SELECT DISTINCT source, sha256(text) AS h FROM documents WHERE trim(coalesce(text, '')) <> ''
    EXCEPT SELECT source, h FROM (SELECT source, sha256(text) AS h, row_number() OVER (PARTITION BY sha256(text) ORDER BY CASE WHEN lang = 'en' THEN 0 ELSE 1 END, doc_id) AS n
    FROM documents WHERE trim(coalesce(text, '')) <> '') WHERE n = 1)"""
)
def mirror_keys(spark, directory):
    """Number of keys that did not survive."""
    rows = _doc_rows(spark, directory)
    return resolve.mirrors(rows, resolve.survivors(rows, "functional")).agg(F.count("*").alias("n"))


@query(
    """WITH i AS (SELECT DISTINCT authority, property_name, url, address FROM mirror_records)
    SELECT DISTINCT a.authority, a.property_name, a.url FROM i a JOIN i b ON a.property_name = b.property_name AND a.authority <> b.authority
    AND ((a.url = b.url AND b.url <> '') OR (length(b.address) >= 8 AND a.address = b.address))"""
)
def alias_rows(spark, directory):
    """Stored rows that are another row under a different authority."""
    rows = table(spark, directory, "mirror_records").select("authority", "property_name", "url", "address").distinct()
    return resolve.aliases(rows, rows)


# Kind of a stored row.
_KIND_SQL = f"""CASE WHEN lower({_strip('source')}) LIKE 'housekeys:%' THEN 'portal'
  WHEN lower({_strip('property_name')}) LIKE '%via housekeys%' THEN 'portal'
  WHEN lower({_strip('property_name')}) IN ({', '.join(f"'{x}'" for x in canonical.PROGRAM_NAMES)}) THEN 'program'
  WHEN {_strip('address')} = '' AND length({_strip('property_name')}) < 24 AND upper({_strip('property_name')}) = {_strip('property_name')} AND lower({_strip('property_name')}) <> {_strip('property_name')}
    AND {_strip('property_name')} LIKE '% %' THEN 'program' ELSE 'property' END"""


# ---- Inventory of events: run = day, source = event type, entity = user ------------------------------------------

_INV_SQL = """
WITH d AS (SELECT max(day) AS run, max(day) FILTER (day < top) AS before FROM (SELECT DISTINCT strftime(ts, '%Y%m%d') AS day, strftime((SELECT max(ts) FROM events), '%Y%m%d') AS top FROM events)),
o AS (SELECT strftime(ts, '%Y%m%d') AS run_id, event_type AS authority, user_id::VARCHAR AS property_name, ts FROM events),
i AS (SELECT authority, property_name, min(run_id) AS first_run_id, max(run_id) AS last_run_id, min(ts) AS first_seen, max(ts) AS last_seen
      FROM o GROUP BY 1, 2),
l AS (SELECT *, CASE WHEN last_run_id = run THEN CASE WHEN first_run_id = run THEN 'NEW' ELSE 'UPDATED' END
      WHEN authority = 'error' THEN 'SCRAPE_FAILED' ELSE 'STALE' END AS change_type FROM i, d)"""


def _observations(spark, directory):
    e = table(spark, directory, "events")
    return e.select(
        F.date_format("ts", "yyyyMMdd").alias("run_id"), F.col("event_type").alias("authority"), F.col("user_id").cast("string").alias("property_name"), F.lit("").alias("url"), "ts"
    )


def _event_runs(spark, directory) -> list[str]:
    """The last two days of events; a day is a run."""
    days = table(spark, directory, "events").select(F.date_format("ts", "yyyyMMdd").alias("run_id")).distinct()
    return [r.run_id for r in days.orderBy(F.desc("run_id")).limit(2).collect()] + ["", ""]


def _event_inventory(spark, directory):
    return (
        _observations(spark, directory)
        .groupBy("authority", "property_name", "url")
        .agg(
            F.min("run_id").alias("first_run_id"), F.max("run_id").alias("last_run_id"), F.date_format(F.min("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("first_seen"),
            F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("last_seen"),
        )
    )


def _failed(spark):
    return spark.createDataFrame([("error",)], "authority string")


@query(_INV_SQL + " SELECT authority, property_name, first_run_id, last_run_id, change_type FROM l")
def run_diff(spark, directory):
    """Label of every entity after a run."""
    return changes.classify(_event_inventory(spark, directory), _event_runs(spark, directory)[0], _failed(spark)).select("authority", "property_name", "first_run_id", "last_run_id", "change_type")


@query(_INV_SQL + " SELECT v.change_type, count(l.change_type)::BIGINT AS n FROM (VALUES ('NEW'), ('UPDATED'), ('STALE'), ('SCRAPE_FAILED')) v(change_type) LEFT JOIN l USING (change_type) GROUP BY 1")
def run_diff_counts(spark, directory):
    """Number of entities with each label."""
    return changes.label_counts(changes.classify(_event_inventory(spark, directory), _event_runs(spark, directory)[0], _failed(spark)))


@query(_INV_SQL + " SELECT authority, property_name, change_type FROM l WHERE authority = 'click'")
def run_diff_partial(spark, directory):
    """Labels of a partial run: one source only."""
    only = spark.createDataFrame([("click",)], "authority string")
    return changes.classify(_event_inventory(spark, directory), _event_runs(spark, directory)[0], _failed(spark), only).select("authority", "property_name", "change_type")


@query(
    """WITH i AS (SELECT event_type AS authority, user_id::VARCHAR AS property_name, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1, 2)
    SELECT authority, property_name, CASE WHEN date_trunc('second', a) = date_trunc('second', b) THEN 'NEW' WHEN date_trunc('second', b) < TIMESTAMP '2024-01-24 00:00:00' THEN 'STALE' ELSE 'UPDATED' END AS change_type FROM i"""
)
def diff_by_time(spark, directory):
    """Labels where no run is known."""
    return _event_inventory(spark, directory).select("authority", "property_name", changes.change_label_by_time("2024-01-31T00:00:00").alias("change_type"))


@query(
    """WITH s AS (SELECT run_id, user_id, max_by(event_type, (ts, event_id)) AS st FROM (SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'first' ELSE 'second' END AS run_id, * FROM events) GROUP BY 1, 2),
    b AS (SELECT * FROM s WHERE run_id = 'first'), a AS (SELECT * FROM s WHERE run_id = 'second')
    SELECT CASE WHEN b.st IS NULL THEN 'ADDED' WHEN a.st IS NULL THEN 'REMOVED' ELSE 'STATUS_CHANGE' END AS event, coalesce(a.user_id, b.user_id)::VARCHAR AS property_name, b.st AS old, a.st AS new
    FROM b FULL JOIN a USING (user_id) WHERE b.st IS DISTINCT FROM a.st"""
)
def snapshot_status_diff(spark, directory):
    """Added, removed and changed between the last states of two halves of a month."""
    e = table(spark, directory, "events").withColumn("run_id", F.when(F.col("ts") < F.lit("2024-01-16").cast("timestamp"), "first").otherwise("second"))
    last = e.groupBy("run_id", "user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("status"))
    rows = last.select("run_id", F.lit("all").alias("authority"), F.col("user_id").cast("string").alias("property_name"), F.lit("").alias("url"), "status", F.lit("").alias("listing_status"))
    out = changes.snapshot_diff(rows.where("run_id = 'first'"), rows.where("run_id = 'second'"))
    return out.select("event", "property_name", "old", "new")


@query(
    _INV_SQL
    + """ SELECT CASE WHEN change_type = 'NEW' THEN 'ADDED' WHEN change_type = 'SCRAPE_FAILED' THEN 'SCRAPE_FAILED' WHEN last_run_id = before THEN 'REMOVED' ELSE 'STALE' END AS event,
    authority, property_name FROM l WHERE change_type <> 'UPDATED'"""
)
def staff_events(spark, directory):
    """Events for staff after a run."""
    labelled = changes.classify(_event_inventory(spark, directory), _event_runs(spark, directory)[0], _failed(spark))
    none = spark.createDataFrame([], "authority string, property_name string, url string, status string, listing_status string")
    return changes.staff_events(labelled, _event_runs(spark, directory)[1], _failed(spark), none, none).select("event", "authority", "property_name")


@query(
    _INV_SQL + """ SELECT CASE WHEN change_type = 'NEW' THEN 'ADDED' WHEN change_type = 'SCRAPE_FAILED' THEN 'SCRAPE_FAILED' WHEN last_run_id = before THEN 'REMOVED' ELSE 'STALE' END AS event,
    authority || ' — ' || property_name AS entry FROM l WHERE change_type <> 'UPDATED'"""
)
def changelog(spark, directory):
    """Rows of the change log."""
    labelled = changes.classify(_event_inventory(spark, directory), _event_runs(spark, directory)[0], _failed(spark))
    none = spark.createDataFrame([], "authority string, property_name string, url string, status string, listing_status string")
    return changes.changelog(changes.staff_events(labelled, _event_runs(spark, directory)[1], _failed(spark), none, none), False).select("event", "entry")


def _stored(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in inv.STORED])


def _order_rows(spark, directory):
    o = table(spark, directory, "orders")
    return o.select(
        F.col("o_orderpriority").alias("authority"), F.col("o_orderkey").cast("string").alias("property_name"), F.lit("").alias("url"), F.col("o_orderstatus").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("last_seen"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("first_seen"),
        F.col("o_orderkey").alias("seq"), "o_custkey", "o_orderdate",
    )


_CUT = "1995-06-01"


@query(
    """SELECT o_orderpriority AS authority, o_orderkey::VARCHAR AS property_name, CASE WHEN o_custkey % 2 = 0 THEN 'R2' ELSE 'R1' END AS last_run_id,
    CASE WHEN o_custkey % 3 = 0 THEN 'R2' ELSE 'R1' END AS first_run_id, CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus ELSE 'old' END AS status
    FROM orders WHERE o_custkey % 3 <> 0 OR o_custkey % 2 = 0"""
)
def merged_inventory(spark, directory):
    """Inventory after a second run was merged into the first."""
    rows = _order_rows(spark, directory)
    shape = [c for c in inv.STORED if c not in ("first_run_id", "last_run_id", "raw_data")]

    def stored(df, run):
        full = df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in shape], "seq")
        return inv.incoming(full, run)

    first = stored(rows.where("o_custkey % 3 <> 0").withColumn("status", F.lit("old")), "R1")
    second = stored(rows.where("o_custkey % 2 = 0"), "R2")
    return inv.merge(first, second).select("authority", "property_name", "last_run_id", "first_run_id", "status")


@query("SELECT count(*) FILTER (o_custkey % 3 = 0)::BIGINT AS inserted, count(*) FILTER (o_custkey % 3 <> 0)::BIGINT AS updated FROM orders WHERE o_custkey % 2 = 0")
def merge_counts(spark, directory):
    """How many keys a merge inserts and updates."""
    rows = _order_rows(spark, directory)
    return inv.merge_counts(rows.where("o_custkey % 3 <> 0"), rows.where("o_custkey % 2 = 0"))


@query("SELECT o_orderkey::VARCHAR AS property_name, CASE WHEN o_custkey % 5 = 0 THEN 'R9' ELSE '' END AS last_run_id FROM orders")
def confirmed_identities(spark, directory):
    """Stored rows touched by keys that a run saw again."""
    rows = _order_rows(spark, directory)
    return inv.confirm(_stored(rows), rows.where("o_custkey % 5 = 0"), "R9", NOW).select("property_name", "last_run_id")


@query(f"SELECT o_orderkey::VARCHAR AS property_name FROM orders WHERE NOT (o_orderdate < DATE '{_CUT}' - INTERVAL 45 DAY AND o_orderpriority = '1-URGENT')")
def pruned_inventory(spark, directory):
    """Inventory without rows of one authority that were not seen for 45 days."""
    rule = inv.prune_rule(_CUT, not_seen_days=45, authority="1-URGENT")
    return inv.prune(_stored(_order_rows(spark, directory)), rule).select("property_name")


@query(_INV_SQL + " SELECT authority, property_name FROM l WHERE change_type <> 'STALE'")
def pruned_by_diff(spark, directory):
    """Inventory without the rows a diff calls stale."""
    rows = _event_inventory(spark, directory)
    return inv.prune_from_diff(rows, changes.classify(rows, _event_runs(spark, directory)[0], _failed(spark))).select("authority", "property_name")


_EXPORT_SQL = ", ".join(
    f"coalesce({c}, '') AS {c}" if c in "property_name address phone email bedrooms url status listing_status income_limits eligibility_flags confidence last_seen first_seen source last_run_id".split() else f"'' AS {c}"
    for c in "property_name address phone email bedrooms url status listing_status deadline income_limits unit_types eligibility_flags notes confidence administrator administrator_url administrator_phone administrator_contact last_seen first_seen source source_url expires_at last_run_id".split()
)


@query(
    f"""SELECT coalesce(authority, '') AS source_authority, {_EXPORT_SQL}, coalesce(last_seen, '') AS scrape_date, {_KIND_SQL} AS record_kind,
    CASE WHEN last_run_id = (SELECT max(run_id) FROM inventory_snapshots) THEN 'Y' ELSE 'N' END AS confirmed_this_run FROM inventory_snapshots"""
)
def export_full(spark, directory):
    """Full export of all delivered rows, with what the last run confirmed."""
    rows = table(spark, directory, "inventory_snapshots")
    last = rows.agg(F.max("run_id")).first()[0]
    return inv.export_full(_stored(rows).fillna(""), last)


@query(
    _INV_SQL
    + " SELECT change_type, authority AS source_authority, property_name, last_run_id, strftime(first_seen, '%Y-%m-%dT%H:%M:%S') AS first_seen, strftime(last_seen, '%Y-%m-%dT%H:%M:%S') AS last_seen, "
    + ", ".join(f"'' AS {c}" for c in "address phone email url status listing_status deadline bedrooms income_limits unit_types eligibility_flags confidence notes source source_url expires_at".split())
    + ", 'property' AS record_kind FROM l"
)
def export_diff(spark, directory):
    """Change export of a run."""
    labelled = changes.classify(_event_inventory(spark, directory), _event_runs(spark, directory)[0], _failed(spark))
    full = labelled.select("change_type", *[F.col(c) if c in labelled.columns else F.lit("").alias(c) for c in inv.STORED])
    return inv.export_diff(full)


@query(
    """SELECT run_id, lag(run_id) OVER (ORDER BY run_id) AS previous FROM (SELECT DISTINCT run_id FROM run_history WHERE coalesce(trim(authority_filter), '') = '')
    WHERE run_id IN (SELECT run_id FROM run_outcomes)"""
)
def previous_runs(spark, directory):
    """Each full run with the one before."""
    return report.last_good_runs(table(spark, directory, "run_outcomes"), table(spark, directory, "run_history"))


@query("SELECT run_id, count(*)::BIGINT AS attempted, count(*) FILTER (had_error)::BIGINT AS failed, count(*) FILTER (NOT coalesce(had_error, false))::BIGINT AS succeeded FROM run_outcomes GROUP BY 1")
def run_figures(spark, directory):
    """Sources attempted, failed and succeeded in each run."""
    return report.run_figures(table(spark, directory, "run_outcomes"))


@query("SELECT id, run_id, command FROM run_history ORDER BY started_at DESC LIMIT 20")
def latest_runs(spark, directory):
    """The twenty latest runs: a top list."""
    return table(spark, directory, "run_history").orderBy(F.desc("started_at")).limit(20).select("id", "run_id", "command")


# ---- Signals and reports ----------------------------------------------------------------------------------------

def _snapshot_rows(spark, directory):
    return table(spark, directory, "inventory_snapshots").withColumns({"administrator": F.lit(""), "notes": F.lit("")})


@query(f"SELECT run_id, {_KIND_SQL} AS kind, count(*)::BIGINT AS n FROM inventory_snapshots GROUP BY 1, 2")
def record_kinds(spark, directory):
    """Kinds of rows of each run."""
    return _snapshot_rows(spark, directory).groupBy("run_id", canonical.record_kind().alias("kind")).agg(F.count("*").alias("n"))


@query(
    f"""SELECT count(*)::BIGINT AS total, count(*) FILTER (k = 'property')::BIGINT AS properties, count(*) FILTER (k = 'portal')::BIGINT AS portals, count(*) FILTER (k = 'program')::BIGINT AS programs
    FROM (SELECT {_KIND_SQL} AS k FROM inventory_snapshots)"""
)
def coverage(spark, directory):
    """Coverage figures of all rows."""
    return report.coverage(_snapshot_rows(spark, directory))


_SIGNAL_SQL = (
    _TARGET_SQL
    + f""", c AS (SELECT authority, count(*) FILTER ({_KIND_SQL} = 'property')::BIGINT AS n FROM inventory_snapshots WHERE run_id = (SELECT max(run_id) FROM inventory_snapshots) GROUP BY 1),
bad AS (SELECT DISTINCT authority FROM run_outcomes WHERE had_error AND run_id = (SELECT max(run_id) FROM inventory_snapshots)),
x AS (SELECT t.authority, coalesce(c.n, 0)::BIGINT AS n, bad.authority IS NOT NULL AS failed, tags,
  try_cast(nullif(regexp_extract(coalesce(validated_zero, ''), '(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1), '') AS DATE) AS noted,
  try_cast(nullif(regexp_extract(coalesce(validated_zero_review_due, ''), '(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1), '') AS DATE) AS due,
  greatest(3, coalesce(list_max(list_transform(tags, lambda m: CASE m {' '.join(f"WHEN '{k}' THEN {v}" for k, v in signals.FLOORS.items())} END)), 0)) AS least
  FROM t LEFT JOIN c ON c.authority = t.authority LEFT JOIN bad ON bad.authority = t.authority),
s AS (SELECT authority, n, failed, CASE WHEN noted IS NULL OR due IS NULL THEN 'none' WHEN DATE '2025-06-15' <= due THEN 'current' ELSE 'due' END AS zero_state,
  CASE WHEN NOT failed AND n = 0 AND zero_state <> 'current' AND NOT list_has_any(tags, ['waf_blocked', 'no_public_list']) AND list_has_any(tags, [{', '.join(f"'{x}'" for x in signals.INVENTORY)}]) THEN 'suspicious_zero'
  WHEN NOT failed AND n > 0 AND n < least THEN 'low_yield' WHEN zero_state = 'due' THEN 'reverification_due' END AS signal FROM x)"""
)


def _signals(spark, directory):
    rows = _snapshot_rows(spark, directory)
    last = rows.agg(F.max("run_id")).first()[0]
    rows = rows.where(F.col("run_id") == last)
    failed = table(spark, directory, "run_outcomes").where(F.col("had_error") & (F.col("run_id") == last)).select("authority").distinct()
    return signals.source_signals(table(spark, directory, "targets"), signals.property_counts(rows), failed, TODAY)


@query(_SIGNAL_SQL + " SELECT * FROM s")
def source_signals(spark, directory):
    """Suspicious zeros, low yields and reviews due."""
    return _signals(spark, directory)


@query(_SIGNAL_SQL + " SELECT DISTINCT authority FROM s WHERE failed OR signal IN ('suspicious_zero', 'low_yield')")
def unreliable_sources(spark, directory):
    """Sources whose missing rows say nothing."""
    return signals.unreliable(_signals(spark, directory))


@query(_SIGNAL_SQL + " SELECT authority, 'Re-verify source: ' || authority AS title, CASE WHEN authority LIKE 'City%' THEN 'update' ELSE 'create' END AS action FROM s WHERE signal IS NOT NULL")
def review_actions(spark, directory):
    """Review tasks to create or update."""
    opened = table(spark, directory, "targets").where("authority LIKE 'City%'").select(F.concat(F.lit("Re-verify source: "), "authority").alias("title"))
    return signals.review_actions(_signals(spark, directory), opened).select("authority", "title", "action")


@query(
    """SELECT n_name AS authority, coalesce(c, 0)::BIGINT AS n, coalesce(c, 0) BETWEEN 2 AND 60 AS inside FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS c FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey"""
)
def count_bounds(spark, directory):
    """Counts of suppliers of each nation against bounds."""
    nation = table(spark, directory, "nation")
    counts = table(spark, directory, "supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("authority")).agg(F.count("*").alias("n"))  # 25 nations, fixed
    return signals.bounds_check(counts, nation.select(F.col("n_name").alias("authority"), F.lit(2).alias("least"), F.lit(60).alias("most")))


@query(
    f"""SELECT tag, missing FROM (SELECT DISTINCT tag, 'handler' AS missing FROM ({_TARGET_SQL} SELECT unnest(tags) AS tag FROM t) WHERE tag NOT IN ({', '.join(f"'{x}'" for x in signals.HANDLERS)})
    UNION ALL SELECT tag, 'declaration' FROM (VALUES {', '.join(f"('{x}')" for x in signals.HANDLERS)}) v(tag) WHERE tag NOT IN (SELECT unnest(tags) FROM ({_TARGET_SQL} SELECT tags FROM t)))"""
)
def handler_drift(spark, directory):
    """Tags of sources without handler, and handlers no source names."""
    declared = table(spark, directory, "targets").select(F.explode(X.measures(F.col("scraping_measures"))).alias("tag")).distinct()
    return signals.handler_drift(declared, spark.createDataFrame([(h,) for h in signals.HANDLERS], "tag string"))


@query(
    """SELECT record_id FROM (SELECT record_id, row_number() OVER (PARTITION BY lower(regexp_replace(substr(property_name, 1, 55), '^\\s+|\\s+$', '', 'g')), coalesce(authority, '') ORDER BY record_id) AS n
    FROM raw_records) WHERE n = 1"""
)
def first_of_each(spark, directory):
    """First raw record of each name and authority."""
    rows = table(spark, directory, "raw_records").select("record_id", "property_name", "authority", F.col("record_id").alias("seq"))
    return report.first_of_each(rows).select("record_id")


@query(
    """SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100"""
)
def top_list(spark, directory):
    """The first hundred customers by balance: a top list."""
    rows, _ = report.top_and_rest(table(spark, directory, "customer"), [F.desc("c_acctbal"), "c_custkey"])
    return rows.select("c_custkey", "c_acctbal")


@query(
    """SELECT date_trunc('day', ts) AS window_start, event_type, count(*)::BIGINT AS n FROM events GROUP BY 1, 2"""
)
def windowed_events(spark, directory):
    """Events of each day and kind; the same plan serves a stream."""
    return windowed_counts(table(spark, directory, "events"), "ts")


@query(
    """SELECT l_returnflag, l_linestatus, sum(l_quantity)::DOUBLE AS quantity, count(*)::BIGINT AS n, count(DISTINCT l_suppkey)::BIGINT AS suppliers FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2"""
)
def load_scan(spark, directory):
    """Scan and aggregation of the largest plain table."""
    rows = table(spark, directory, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("quantity"), F.count("*").alias("n"), F.count_distinct("l_suppkey").alias("suppliers")
    )
