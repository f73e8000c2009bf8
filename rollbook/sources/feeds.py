"""JSON feeds and paged sources: nested listings, GeoJSON and map services."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from rollbook.functions import text as X

UNIT = "struct<numBedrooms:int,amiPercentage:string,monthlyRent:string>"
ITEM = (
    "struct<id:string,name:string,status:string,marketingType:string,isWaitlistOpen:boolean,waitlistOpenSpots:string,"
    "waitlistCurrentSize:string,reviewOrderType:string,lotteryStatus:string,applicationDueDate:string,applicationFee:string,"
    "digitalApplication:boolean,paperApplication:boolean,rentalAssistance:string,leasingAgentPhone:string,leasingAgentEmail:string,"
    "leasingAgentName:string,developer:string,urlSlug:string,servicesOffered:string,reservedCommunityDescription:string,"
    "reservedCommunityMinAge:string,unitsAvailable:string,buildingTotalUnits:string,"
    "reservedCommunityTypes:array<struct<name:string>>,"
    "listingsBuildingAddress:struct<street:string,street2:string,city:string,state:string,zipCode:string>,"
    f"units:array<{UNIT}>,"
    "unitsSummarized:struct<byUnitTypeAndRent:array<struct<unitTypes:struct<name:string>,rentRange:struct<min:string,max:string>>>>>"
)


def page_data(html: Column) -> Column:
    """JSON text of a page's data script."""
    return F.nullif(F.regexp_extract(html, r'(?s)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1), F.lit(""))


def portal_items(pages: DataFrame) -> DataFrame:
    """Open, then closed listings of portal pages ``page_id, url, html``: ``page_id, url, rank, item``."""
    props = f"struct<openListings:array<{ITEM}>,closedListings:array<{ITEM}>>"
    schema = f"props struct<pageProps:{props}>, pageProps {props}"
    data = pages.select("page_id", "url", F.from_json(page_data(F.col("html")), schema).alias("d"))
    lists = data.select("page_id", "url", F.coalesce("d.props.pageProps", "d.pageProps").alias("p"))
    nothing = F.array().cast(f"array<{ITEM}>")
    return lists.select(
        "page_id", "url", F.posexplode(F.concat(F.coalesce("p.openListings", nothing), F.coalesce("p.closedListings", nothing))).alias("rank", "item")
    )


def once(items: DataFrame, most: int = 200) -> tuple[DataFrame, DataFrame]:
    """Each listing of a page once, by id or name, the first; and ``page_id`` of pages with more than ``most``, whose reading should have stopped there."""
    key = X.first_said(F.col("item.id"), F.col("item.name"))
    first = items.where(key != "").groupBy("page_id", "url", key.alias("key")).agg(F.min_by(F.struct("rank", "item"), "rank").alias("r"))
    rows = first.select("page_id", "url", "r.rank", "r.item")
    over = rows.groupBy("page_id").count().where(F.col("count") > most).select("page_id")
    return rows, over


def unit_summary(units: Column) -> Column:
    """Bedroom counts with their income levels: "Studio (60% AMI), 1BR (50–60% AMI)"."""
    known = F.filter(F.coalesce(units, F.array().cast(f"array<{UNIT}>")), lambda u: u["numBedrooms"].isNotNull())
    sizes = F.array_sort(F.array_distinct(F.transform(known, lambda u: u["numBedrooms"])))

    def part(size: Column) -> Column:
        levels = F.array_distinct(
            F.transform(F.filter(known, lambda u: (u["numBedrooms"] == size) & (X.said(u["amiPercentage"]) != "")), lambda u: u["amiPercentage"])
        )
        ranked = F.transform(
            F.array_sort(F.transform(levels, lambda a: F.struct(F.coalesce(a.try_cast("int"), F.lit(0)).alias("n"), a.alias("a")))), lambda s: s["a"]
        )
        label = F.when(size == 0, "Studio").otherwise(F.concat(size.cast("string"), F.lit("BR")))
        return F.when(F.size(ranked) > 0, F.concat(label, F.lit(" ("), F.array_join(ranked, "–"), F.lit("% AMI)"))).otherwise(label)

    return F.array_join(F.transform(sizes, part), ", ")


def _joined(*columns: Column) -> Column:
    return F.concat_ws(" ", *[F.nullif(F.trim(X.said(c)), F.lit("")) for c in columns])


def portal_records(items: DataFrame, authority: Column) -> DataFrame:
    """Raw records of portal listings (``url, rank, item``); items without name drop out."""
    i = {name: F.col(f"item.{name}") for name in ("id", "name", "status", "marketingType", "urlSlug")}
    a = F.col("item.listingsBuildingAddress")
    state = F.concat_ws(" ", F.nullif(X.said(a["state"]), F.lit("")), F.nullif(X.said(a["zipCode"]), F.lit("")))
    address = F.concat_ws(", ", F.nullif(_joined(a["street"], a["street2"]), F.lit("")), F.nullif(X.stripped(a["city"]), F.lit("")), F.nullif(state, F.lit("")))
    status, coming = X.stripped(i["status"]), X.said(i["marketingType"]) == "comingSoon"
    base = F.when((status == "active") & coming, "coming_soon").when(status == "active", "open").when(status == "closed", "closed").otherwise(status)
    waitlist = F.coalesce("item.isWaitlistOpen", F.lit(False))
    spots = X.said(F.col("item.waitlistOpenSpots"))
    fee = X.said(F.col("item.applicationFee"))
    review = X.stripped(F.col("item.reviewOrderType"))
    lottery = X.stripped(F.col("item.lotteryStatus"))
    ways = F.concat_ws("/", F.when(F.col("item.digitalApplication"), "online"), F.when(F.col("item.paperApplication"), "paper"))
    help_text = F.lower(X.said(F.col("item.rentalAssistance")))
    notes = F.concat_ws(
        "; ",
        F.when((status == "active") & coming, "coming soon — not yet accepting applications")
        .when(status == "active", "accepting applications")
        .when(status == "closed", "closed — not currently accepting applications")
        .when(status != "", F.concat(F.lit("status: "), status)),
        F.when(review == "lottery", F.concat(F.lit("lottery system"), F.when(lottery != "", F.concat(F.lit(": "), lottery)).otherwise("")))
        .when(review == "firstComeFirstServe", "first-come first-served"),
        F.when(waitlist & (spots != ""), F.concat(F.lit("waitlist open ("), spots, F.lit(" spots)")))
        .when(waitlist, "waitlist open")
        .when(X.said(F.col("item.waitlistCurrentSize")) != "", F.concat(F.lit("waitlist size: "), F.col("item.waitlistCurrentSize"))),
        F.when(X.said(F.col("item.applicationDueDate")) != "", F.concat(F.lit("due: "), F.left(F.col("item.applicationDueDate"), F.lit(10)))),
        F.when(~fee.isin("", "0"), F.concat(F.lit("app fee: $"), fee)),
        F.when(ways != "", F.concat(F.lit("application: "), ways)),
        F.when(help_text.contains("voucher") | help_text.contains("section 8"), "accepts Section 8 / vouchers"),
    )
    groups = F.array_join(F.filter(F.transform(F.col("item.reservedCommunityTypes"), lambda t: t["name"]), lambda n: n.isNotNull()), ", ")
    summarised = F.array_join(
        F.transform(
            F.col("item.unitsSummarized.byUnitTypeAndRent"),
            lambda e: F.concat(
                _unit_label(e["unitTypes"]["name"]),
                F.coalesce(F.concat(F.lit(" ("), F.nullif(F.concat_ws("–", e["rentRange"]["min"], e["rentRange"]["max"]), F.lit("")), F.lit(")")), F.lit("")),
            ),
        ),
        ", ",
    )
    free, whole = X.said(F.col("item.unitsAvailable")), X.said(F.col("item.buildingTotalUnits"))
    counted = F.when(whole != "", F.concat(X.first_said(free, F.lit("?")), F.lit(" of "), whole, F.lit(" units"))).when(free != "", F.concat(free, F.lit(" available")))
    detail = F.concat(F.regexp_replace(F.col("url"), r"[/?#]+$", ""), F.lit("/"), i["id"], F.when(X.said(i["urlSlug"]) != "", F.concat(F.lit("/"), i["urlSlug"])).otherwise(""))
    phone, email = X.stripped(F.col("item.leasingAgentPhone")), X.stripped(F.col("item.leasingAgentEmail"))
    return items.where(X.stripped(i["name"]) != "").select(
        authority.alias("authority"),
        X.stripped(i["name"]).alias("property_name"),
        F.when(X.said(i["id"]) != "", detail).otherwise(F.col("url")).alias("document_url"),
        address.alias("address"),
        phone.alias("phone"),
        email.alias("email"),
        X.stripped(X.first_said(F.col("item.leasingAgentName"), F.col("item.developer"))).alias("administrator"),
        X.first_said(unit_summary(F.col("item.units")), X.said(summarised), X.said(counted)).alias("bedrooms"),
        X.first_said(X.said(groups), X.stripped(F.col("item.reservedCommunityDescription"))).alias("eligibility_flags"),
        F.when(waitlist & (base != "open"), "waitlist").otherwise(base).alias("listing_status"),
        F.when(notes != "", notes).otherwise(F.concat(F.lit("listing id:"), X.said(i["id"]))).alias("notes"),
        F.when((address != "") & ((phone != "") | (email != "")), "high").otherwise("medium").alias("confidence"),
        F.when(X.said(i["id"]) != "", F.concat(F.lit("bloom:"), i["id"])).otherwise("bloom").alias("source"),
        F.col("rank").cast("long").alias("seq"),
    )


def _unit_label(name: Column) -> Column:
    low = F.lower(X.said(name))
    out = X.first_said(name, F.lit("Unknown"))
    for known, label in (("studio", "Studio"), ("onebdrm", "1BR"), ("twobdrm", "2BR"), ("threebdrm", "3BR"), ("fourbdrm", "4BR")):
        out = F.when(low == known, label).otherwise(out)
    return out


def city_of(authority: Column) -> Column:
    """City that an authority's label names."""
    return F.trim(F.regexp_replace(F.regexp_replace(authority, r"^(City|Town) of ", ""), r"\s*\([^)]*\)\s*$", ""))


def embedded_json(script: Column) -> Column:
    """From the first brace to the last."""
    return F.nullif(F.regexp_extract(script, r"(?s)(\{.*\})", 1), F.lit(""))


GEOJSON = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"


def _pick(fields: Column, *names: str) -> Column:
    return F.coalesce(*[F.nullif(F.trim(fields[n]), F.lit("")) for n in names])


def geo_records(layers: DataFrame) -> DataFrame:
    """Records of GeoJSON layers ``authority, url, body``, also inside a script."""
    f = layers.select("authority", "url", F.explode(F.from_json(embedded_json(F.col("body")), GEOJSON)["features"]).alias("f"))
    p = F.col("f.properties")
    point = F.from_json("f.geometry.coordinates", "array<double>")
    at = F.when(
        (F.col("f.geometry.type") == "Point") & (F.size(point) >= 2), F.format_string(" | approx lat/lon: %.5f, %.5f", point[1], point[0])
    ).otherwise("")
    return f.select(
        "authority",
        F.coalesce(_pick(p, "Name", "name", "PROPERTY_NAME", "ProjectName", "description"), F.lit("Property")).alias("property_name"),
        F.coalesce(_pick(p, "NumUnits", "units", "UNIT_COUNT", "TotalUnits"), F.lit("")).alias("unit_types"),
        F.concat(F.lit("Source: municipal GIS layer ("), F.col("url"), F.lit(")"), at).alias("notes"),
        F.lit("medium").alias("confidence"),
        F.concat(F.lit("gis:"), F.replace(F.lower("authority"), F.lit(" "), F.lit("_"))).alias("source"),
        F.col("url").alias("source_url"),
    )


def map_records(pages: DataFrame) -> DataFrame:
    """Records of map-service pages ``authority, url, body``: attributes are met whatever their case."""
    rows = pages.select("authority", "url", F.explode(F.from_json("body", "features array<struct<attributes:map<string,string>>>")["features"]).alias("f"))
    a = F.map_filter(F.transform_keys("f.attributes", lambda k, v: F.lower(k)), lambda k, v: v.isNotNull() & ~v.isin("", "Null"))

    def pick(*names: str) -> Column:
        return F.coalesce(*[F.trim(F.col("a")[n.lower()]) for n in names])

    told = rows.select("authority", "url", a.alias("a"))
    manager = pick("Agency", "Manager", "PropertyManager", "Owner")
    notes = F.concat_ws(
        " | ",
        F.lit("Source: municipal ArcGIS layer"),
        *[
            F.concat(F.lit(f"{label}: "), pick(*names))
            for label, *names in (
                ("Building type", "BuildingType", "ProjectType"),
                ("Income level", "Income_Level", "IncomeLevel", "AMI"),
                ("Population", "PopulationServed", "Population"),
            )
        ],
        F.concat(F.lit("Manager: "), manager),
    )
    name = pick("Name", "PROPERTY_NAME", "ProjectName", "SiteName")
    return told.where(name.isNotNull()).select(
        "authority",
        name.alias("property_name"),
        X.said(pick("Address", "SiteAddress", "FullAddress")).alias("address"),
        X.said(pick("PhoneNumber", "Phone")).alias("phone"),
        X.said(pick("Website", "URL", "Link")).alias("url"),
        X.said(pick("AffordableUnits", "NumUnits", "TotalUnits", "Units", "UNIT_COUNT")).alias("unit_types"),
        X.said(pick("Bedrooms", "UnitTypes")).alias("bedrooms"),
        X.said(manager).alias("administrator"),
        notes.alias("notes"),
        F.lit("high").alias("confidence"),
        F.col("url").alias("source_url"),
    )


def rest_records(pages: DataFrame, cities: dict[str, str]) -> DataFrame:
    """Records of a content service's pages ``url, body``: titles unescaped, the first known city id named."""
    schema = "array<struct<id:string,link:string,title:struct<rendered:string>,city:array<string>>>"
    rows = pages.select(F.explode(F.from_json("body", schema)).alias("r"))
    names = F.create_map(*[F.lit(x) for pair in cities.items() for x in pair]) if cities else F.lit(None).cast("map<string,string>")
    city = F.try_element_at(F.filter(F.transform("r.city", lambda c: names[c]), lambda n: n.isNotNull()), F.lit(1))
    title = F.col("r.title.rendered")
    for mark, sign in (("&#8217;", "’"), ("&#8211;", "–"), ("&quot;", '"'), ("&#039;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        title = F.replace(title, F.lit(mark), F.lit(sign))
    return rows.select(title.alias("property_name"), F.col("r.link").alias("url"), F.coalesce(F.concat(city, F.lit(", CA")), F.lit("")).alias("address"))


def walk_pages(fetch: Callable[[int], tuple[list, bool]], most: int) -> tuple[list, str | None]:
    """Items of pages 1, 2, ... until one says there is no more, and what went wrong: an empty page that promises more, or the cap."""
    items: list = []
    for n in range(1, most + 1):
        page, more = fetch(n)
        items += page
        if not more:
            return items, None
        if not page:
            return items, f"page {n} is empty but promises more"
    return items, f"more than {most} pages"


class _Host(InputPartition):
    def __init__(self, host: str, urls: list[str]):
        self.host, self.urls = host, urls


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[_Host]:
        """One partition for each host, so that a host meets one reader at a time."""
        by: dict[str, list[str]] = {}
        for url in self.options["urls"].split(" "):
            by.setdefault(url.split("/")[2] if "://" in url else "", []).append(url)
        return [_Host(h, u) for h, u in sorted(by.items())]

    def read(self, partition: _Host) -> Iterator[tuple]:
        import importlib

        module, _, name = self.options["fetch"].partition(":")
        fetch = getattr(importlib.import_module(module), name)
        for url in partition.urls:
            items, trouble = walk_pages(lambda n, url=url: fetch(url, n), int(self.options.get("most", 20)))
            for k, item in enumerate(items):
                yield (url, k, item, False, None)
            yield (url, len(items), None, trouble is not None, trouble)


class PagedSource(DataSource):
    """Paged sources behind a fetch function ``module:name`` (url, page) -> (texts, more).

    Rows are items; the last row of each source tells whether it failed, so that
    what was read before an error is kept.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "url string, seq long, item string, had_error boolean, error string"

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.options)


def read_paged(spark: SparkSession, urls: list[str], fetch: str, most: int = 20) -> DataFrame:
    """Items and outcomes of paged sources."""
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged").options(urls=" ".join(urls), fetch=fetch, most=str(most)).load()
