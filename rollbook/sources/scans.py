"""Scans composed of several reads: what is tried first, what ends a scan, and what is kept when it fails."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions import text as X
from rollbook.sources import documents as docs
from rollbook.sources import feeds, pages

# Answers worth another try, tries, seconds of the first pause, and the most bytes of a body.
TRY_AGAIN = (429, 500, 502, 503, 504)
TRIES, PAUSE, MOST_BYTES = 3, 1.5, 20 * 1024 * 1024
# Words in links to map data, and how many such links a page scan follows.
MAP_WORDS = ("units", "bmr", "rentals", "portfolio", "gis", "features", "geojson")
MAP_LINKS = 8
# Rows of a map service's page, pages at most, and listings of a portal at most.
MAP_PAGE, MAP_PAGES, PORTAL_MOST = 500, 20, 200
# Words of links to published documents, of flyers' labels, and hosts with a reader of their own.
DOCUMENT_WORDS = ("showpublisheddocument", "publisheddocument", "documentcenter", "docaccess", ".pdf")
FLYER_WORDS = ("official flyer", "50%ami", "60%ami", "50ami", "60ami")
OWN_READERS = ("housinginc.org",)
# Keys of settings objects, and of listings that say much or something.
SETTING_STARTS = ("enable", "show", "limit", "export", "allow", "require")
STRONG_KEYS = ("name", "title", "property", "address", "status", "application", "id", "slug")
WEAK_KEYS = ("bedrooms", "units", "ami", "income", "manager", "contact", "rent")


def bounded_get(
    opener: Callable[[str], tuple[int, object]], url: str, tries: int = TRIES, most: int = MOST_BYTES, sleep: Callable[[float], None] = time.sleep
) -> bytes | None:
    """Body of ``url``, or None: after ``tries`` answers worth another try, at any other bad answer, or beyond ``most`` bytes.

    ``opener`` gives status and an object with ``read(n)``; a raised OSError counts as an answer worth another try.
    """
    for n in range(1, tries + 1):
        try:
            status, body = opener(url)
        except OSError:
            status, body = TRY_AGAIN[0], None
        if status in TRY_AGAIN:
            if n < tries:
                sleep(PAUSE * n)
            continue
        if status != 200 or body is None:
            return None
        got = body.read(most + 1)
        return got if len(got) <= most else None
    return None


def map_pager(get: Callable[[str], bytes | None], size: int = MAP_PAGE) -> Callable[[str, int], tuple[list[str], bool]]:
    """A fetch function for paged reading of a map service: pages by offset, more while the service says so or a page is full."""

    def fetch(url: str, page: int) -> tuple[list[str], bool]:
        sign = "&" if "?" in url else "?"
        body = get(f"{url}{sign}resultOffset={(page - 1) * size}&resultRecordCount={size}")
        if body is None:
            raise OSError(f"page {page} of {url} cannot be read")
        data = json.loads(body)
        features = data.get("features") or []
        return [json.dumps(f) for f in features], bool(data.get("exceededTransferLimit")) or len(features) >= size

    return fetch


def city_of(authority: Column) -> Column:
    """City that an authority's label names: without "City of", "Town of" and a trailing note in brackets."""
    bare = F.regexp_replace(X.said(authority), r"\s*\([^)]*\)\s*$", "")
    return F.trim(F.regexp_replace(bare, r"^\s*(?:City|Town) of\s+", ""))


def in_city(items: DataFrame) -> DataFrame:
    """Items whose building's city is ``city``, case ignored; an empty city lets all through."""
    own = F.lower(F.trim(X.said(F.col("item.listingsBuildingAddress.city"))))
    return items.where((X.said(F.col("city")) == "") | (own == F.lower(F.trim("city"))))


def portal_inventory(portals: DataFrame, shown: DataFrame, served: DataFrame, service: DataFrame, most: int = PORTAL_MOST) -> tuple[DataFrame, DataFrame]:
    """Listings of portals by the first way that gives any, and how each portal ended.

    ``portals``: ``page_id, city``; ``shown``: items of pages' data scripts, ``served``:
    items of the service (both ``page_id, url, rank, item``); ``service``: ``page_id,
    complete`` of its paging. The page comes first; a service that did not come to
    its end ends the portal with what was read. City filter, then each listing once, open ones before closed ones
    by ``rank``, at most ``most``. Results: ``page_id, url, rank, item`` and
    ``page_id, path, n, had_error, error_kind`` (``incomplete``, ``truncated``, ``empty`` or NULL).
    """
    on_page = shown.select("page_id").distinct().withColumn("on_page", F.lit(True))
    by_service = served.select("page_id").distinct().withColumn("by_service", F.lit(True))
    ways = (
        portals.join(on_page, "page_id", "left").join(by_service, "page_id", "left").join(service.select("page_id", "complete").distinct(), "page_id", "left")
    ).select(
        "page_id",
        "city",
        F.when(F.col("on_page"), "page").when(F.col("by_service") | ~F.coalesce("complete", F.lit(True)), "service").otherwise("empty").alias("path"),
        F.coalesce("complete", F.lit(True)).alias("complete"),
    )
    both = shown.withColumn("path", F.lit("page")).unionByName(served.withColumn("path", F.lit("service")))
    chosen = in_city(both.join(ways, ["page_id", "path"])).select("page_id", "url", "rank", "item")
    each, over = feeds.once(chosen, most)
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy("rank"))
    rows = each.withColumn("nth", nth).where(F.col("nth") <= most).drop("nth")
    ended = (
        ways.join(rows.groupBy("page_id").agg(F.count("*").alias("n")), "page_id", "left")
        .join(over.withColumn("over", F.lit(True)), "page_id", "left")
        .select(
            "page_id",
            "path",
            F.coalesce("n", F.lit(0)).alias("n"),
            F.when((F.col("path") == "service") & ~F.col("complete"), "incomplete").when(F.col("over"), "truncated").when(F.coalesce("n", F.lit(0)) == 0, "empty").alias("error_kind"),
        )
    )
    return rows, ended.select("page_id", "path", "n", F.col("error_kind").isNotNull().alias("had_error"), "error_kind")


def map_links(found: DataFrame, most: int = MAP_LINKS) -> DataFrame:
    """Links of a page that may lead to map data, each once, in order: ``page_id, href, nth``; ``most`` of a page at most."""
    low = F.lower("href")
    kept = found.where(F.array_contains(F.transform(F.array(*[F.lit(w) for w in MAP_WORDS]), lambda w: F.contains(low, w)), F.lit(True)))
    first = kept.groupBy("page_id", "href").agg(F.min("seq").alias("seq"))
    order = Window.partitionBy("page_id").orderBy("seq")
    return first.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most).select("page_id", "href", "nth")


def map_page(found_pages: DataFrame, linked: DataFrame, layers: DataFrame) -> DataFrame:
    """Records of pages with map data: those of their own scripts, else those of the first link that holds any.

    ``found_pages``: ``page_id, authority, url, html``; ``linked``: :func:`map_links`;
    ``layers``: ``href, body`` of what was read.
    """
    own = feeds.geo_records(found_pages.select("authority", "url", F.col("html").alias("body")))
    bare = found_pages.join(own.select(F.col("source_url").alias("url")).distinct(), "url", "left_anti").select("page_id", "authority")
    read = bare.join(linked, "page_id").join(layers, "href").select("page_id", "nth", "authority", F.col("href").alias("url"), "body")
    other = feeds.geo_records(read.select("authority", "url", "body"))
    ranked = other.join(read.select(F.col("url").alias("source_url"), "page_id", "nth"), "source_url")
    first = ranked.withColumn("best", F.min("nth").over(Window.partitionBy("page_id"))).where("nth = best").drop("page_id", "nth", "best")
    return own.unionByName(first.select(*own.columns))


def document_links(found: DataFrame, host_of_page: DataFrame) -> DataFrame:
    """Links to published documents: on the page's own site or a known document host, each once, in order.

    ``found``: ``page_id, seq, href, ...``; ``host_of_page``: ``page_id, url``.
    """
    low = F.lower("href")
    host, base = F.lower(X.said(F.try_parse_url("href", F.lit("HOST")))), F.lower(X.said(F.try_parse_url("url", F.lit("HOST"))))
    words = F.array(*[F.lit(w) for w in DOCUMENT_WORDS])
    kept = found.join(host_of_page.select("page_id", "url"), "page_id").where(
        F.exists(words, lambda w: F.contains(low, w))
        & ~F.exists(F.array(*[F.lit(w) for w in OWN_READERS]), lambda w: F.contains(low, w))
        & X.url_allowed(F.col("href"))
        & ((host == base) | F.endswith(host, F.concat(F.lit("."), base)) | host.contains("documentcenter") | host.contains("docaccess") | low.contains("showpublisheddocument"))
    )
    return kept.groupBy("page_id", "href").agg(F.min_by("label", "seq").alias("label"), F.min("seq").alias("seq"))


def document_title(href: Column) -> Column:
    """Title of a document-centre link, as its words; empty for other links."""
    words = F.regexp_replace(F.regexp_extract(href, r"/DocumentCenter/View/\d+/([A-Za-z0-9_-]+)", 1), "[-_]", " ")
    bare = F.trim(F.regexp_replace(words, r"(?i)\s*(Flyer|Event|Calendar)\s*", " "))
    return F.trim(F.regexp_replace(bare, r"(?i)\s*(\d+)\s*(?:%\s*)?ami\s*$", " ($1% AMI)"))


def flyer_links(found: DataFrame) -> DataFrame:
    """Flyers of availability pages with the name they are for: ``page_id, seq, href, label, name``.

    ``found`` has ``around``, the nearest "Name - N available" of a link's surroundings; without it the link's own words name it.
    """
    low = F.lower("label")
    kept = found.where(F.lower("href").contains("documentcenter/view") & F.exists(F.array(*[F.lit(w) for w in FLYER_WORDS]), lambda w: F.contains(low, w)))
    return kept.select("page_id", "seq", "href", "label", X.first_said(F.col("around"), document_title(F.col("href"))).alias("name"))


def city_page(site: DataFrame, read: DataFrame, budget: int = pages.DOCUMENT_BUDGET) -> tuple[DataFrame, DataFrame]:
    """Records of city pages - availability lists, tables, flyers and the documents they lead to - and how each page ended.

    ``site``: ``page_id, authority, url, html``; ``read``: ``href, text`` of documents
    that could be read. Documents beyond ``budget`` are not taken, the page then ends
    with an error and keeps what it has. Records: ``page_id, method, property_name,
    address, phone, email, source_url``; endings: ``page_id, n, documents, beyond, had_error``.
    """
    listed = pages.page_records(site, "availability").select(
        "page_id", F.lit("availability_list").alias("method"), *[F.col("record")[c].alias(c) for c in ("property_name", "address", "phone", "email")]
    ).join(site.select("page_id", F.col("url").alias("source_url")), "page_id")
    cells = pages.table_rows(site).select(
        "page_id",
        F.lit("table").alias("method"),
        *[F.coalesce(*[F.col("cells")[k] for k in keys]).alias(c) for c, keys in _TABLE_FIELDS.items()],
    ).join(site.select("page_id", F.col("url").alias("source_url")), "page_id")
    found = pages.links(site)
    flyers = flyer_links(found)
    wanted = pages.documents_to_read(document_links(found, site), budget)
    lines = docs.lines_of(wanted.where("within_budget").join(read, "href").select(F.struct("page_id", "href").alias("key"), "text"), "key", "text")
    told = docs.line_records(lines, "key").select(
        "key.page_id", F.col("key.href").alias("document_url"), F.lit("document").alias("method"), "property_name", "address", "phone", "email"
    )
    names = flyers.groupBy("href").agg(F.min_by("name", "seq").alias("name"))
    documents = pages.fill_names(told, names).select("page_id", "method", "property_name", "address", "phone", "email", F.col("document_url").alias("source_url"))
    rows = listed.select(*documents.columns).unionByName(cells.select(*documents.columns)).unionByName(documents)
    beyond = wanted.groupBy("page_id").agg(F.count_if("within_budget").alias("documents"), F.count_if(~F.col("within_budget")).alias("beyond"))
    ended = (
        site.select("page_id")
        .join(rows.groupBy("page_id").agg(F.count("*").alias("n")), "page_id", "left")
        .join(beyond, "page_id", "left")
        .na.fill(0, ["n", "documents", "beyond"])
        .withColumn("had_error", (F.col("beyond") > 0) | (F.col("n") == 0))
    )
    return rows, ended


_TABLE_FIELDS = {
    "property_name": ("property", "property_name", "complex", "name", "apartment"),
    "address": ("address", "property_address", "location"),
    "phone": ("phone", "phone_number", "contact"),
    "email": ("email", "e-mail"),
}


def looks_like_listing(keys: Column) -> Column:
    """Whether an object with these keys is a listing: not a settings object, and with enough keys that listings have."""
    low = F.transform(keys, F.lower)
    flags = F.size(F.filter(low, lambda k: F.exists(F.array(*[F.lit(p) for p in SETTING_STARTS]), lambda p: F.startswith(k, p))))
    strong = F.size(F.array_intersect(low, F.array(*[F.lit(k) for k in STRONG_KEYS])))
    weak = F.size(F.array_intersect(low, F.array(*[F.lit(k) for k in WEAK_KEYS])))

    def has(key: str) -> Column:
        return F.array_contains(low, key)

    sure = has("name") & (has("id") | has("status") | has("listingsbuildingaddress"))
    return (flags <= 3) & ~has("buildid") & ~has("runtime") & (sure | (strong + weak / 2 >= 1.5))


def looks_like_header(cells: Column) -> Column:
    """Whether a row of cells is a header: two of the words that headers have."""
    joined = F.lower(F.array_join(cells, " "))
    return F.size(F.filter(F.array(*[F.lit(w) for w in docs.HEADER_WORDS]), lambda w: F.contains(joined, w))) >= 2


def prune_days(settings: str | None, default: int = 45) -> int:
    """``database: prune: default_not_seen_days`` of a settings text in YAML; ``default`` where it is missing or no number."""
    path: list[tuple[int, str]] = []
    for line in (settings or "").splitlines():
        m = re.match(r"^(\s*)([\w-]+)\s*:\s*([^#]*)", line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, m[2])]
        if [p[1] for p in path] == ["database", "prune", "default_not_seen_days"]:
            value = m[3].strip().strip("'\"")
            return int(value) if re.fullmatch(r"\d+", value) else default
    return default
