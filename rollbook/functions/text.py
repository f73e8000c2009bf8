"""Column expressions on text: trimming, keys, labels, sanitising. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes of property names, in order, each with a leading blank.
NAME_SUFFIXES = tuple(
    f" {x}"
    for x in (
        "senior apartments|family apartments|senior housing|family housing|apartments|apartment|housing|homes|village"
        "|gardens|court|plaza|park|studios|lofts|way|drive|senior|family"
    ).split("|")
)
# Street words and their short forms, in order.
STREET_FORMS = (
    ("street|st", "st"),
    ("avenue|ave", "ave"),
    ("drive|dr", "dr"),
    ("road|rd", "rd"),
    ("boulevard|blvd", "blvd"),
    ("lane|ln", "ln"),
    ("court|ct", "ct"),
    ("place|pl", "pl"),
    ("way", "way"),
    ("circle|cir", "cir"),
    ("terrace|ter", "ter"),
)
# Labels of listing statuses.
STATUS_LABELS = {"open": "Open", "waitlist": "Waitlist", "coming_soon": "Coming Soon", "closed": "Closed"}
KEY_MARK = "roll:"


def said(column: Column) -> Column:
    """Text of a column; NULL is empty."""
    return F.coalesce(column, F.lit(""))


def stripped(column: Column) -> Column:
    """Text without any kind of white space at its ends; NULL is empty."""
    return F.regexp_replace(said(column), r"(?U)^\s+|\s+$", "")


def first_said(*columns: Column) -> Column:
    """The first text that is not empty, else empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def alnum(column: Column) -> Column:
    """Lower case, ASCII letters and digits only."""
    return F.regexp_replace(F.lower(column), "[^a-z0-9]", "")


def authority_label(column: Column) -> Column:
    """One label for each agency: known portfolios by their names, else the text itself without blanks at its ends."""
    text = stripped(column)
    low = F.lower(text)
    # Portfolio agencies; the first that fits counts.
    return (
        F.when(low.startswith("john stewart") | low.contains("john stewart company"), "John Stewart Company")
        .when(low.contains("sccha") | low.contains("santa clara county housing authority"), "Santa Clara County Housing Authority")
        .when(low.contains("housing group"), "Housing Group")
        .when(low.contains("midpen"), "MidPen Housing")
        .when(low.contains("charities housing"), "Charities Housing")
        .when(low.contains("eden housing"), "Eden Housing")
        .when(low.contains("eah housing") | (F.split(low, r"\s+")[0] == "eah"), "EAH Housing")
        .otherwise(text)
    )


def name_key(column: Column) -> Column:
    """Name without the usual suffixes, letters and digits only.

    A fold over the suffixes: at the end a suffix is cut, elsewhere it becomes a blank.
    """
    folded = F.aggregate(
        F.array(*[F.lit(s) for s in NAME_SUFFIXES]),
        F.lower(said(column)),
        lambda acc, s: F.when(acc.endswith(s), F.left(acc, F.length(acc) - F.length(s))).otherwise(F.replace(acc, s, F.lit(" "))),
    )
    return F.regexp_replace(folded, "[^a-z0-9]", "")


def address_key(column: Column) -> Column:
    """House number and street up to the first comma; without them the first 40 letters and digits."""
    text = F.lower(said(column))
    for words, short in STREET_FORMS:
        text = F.regexp_replace(text, rf"\b({words})\b", short)
    found = alnum(F.regexp_extract(text, r"\d{1,6}\s+[a-z][a-z0-9\-\s]{0,40}", 0))
    street = F.regexp_extract(found, r"^\d{1,6}[a-z][a-z0-9]{0,24}", 0)
    return F.coalesce(F.nullif(street, F.lit("")), F.left(alnum(text), F.lit(40)))


def is_street_key(key: Column) -> Column:
    """Whether an address key is long enough and has a digit."""
    return (F.length(key) >= 6) & key.rlike("[0-9]")


def listing_url(own: Column, where: Column, key: Column, label: Column, source: Column, title: Column) -> Column:
    """Address of a listing for its identity: its own, else a stable stand-in from address, name or source.

    All given without blanks at their ends; ``key`` is the address's key and
    ``label`` the authority's. Long expressions: name them in a select before.
    """
    slug = F.left(alnum(label), F.lit(20))
    told = F.concat(
        title,
        F.when(where != "", F.concat(F.lit(":"), F.left(key, F.lit(15)))).otherwise(""),
        F.when(source != "", F.concat(F.lit(":"), F.right(source, F.lit(20)))).otherwise(""),
    )
    digest = F.left(F.sha2(told, 256), F.lit(8))
    return (
        F.when(own != "", own)
        .when(is_street_key(key), F.concat(F.lit(f"{KEY_MARK}addr:"), key))
        .when(title != "", F.concat(F.lit(KEY_MARK), F.when(source != "", "src:").otherwise("prop:"), slug, F.lit(":"), digest))
        .when(slug != "", F.concat(F.lit(f"{KEY_MARK}prop:"), slug, F.lit(":unknown")))
        .otherwise("")
    )


def status_label(listing_status: Column, status: Column) -> Column:
    """Label of the listing status, else the status as given, else Unknown."""
    labels = F.create_map(*[F.lit(x) for pair in STATUS_LABELS.items() for x in pair])
    return F.coalesce(labels[F.lower(stripped(listing_status))], F.nullif(stripped(status), F.lit("")), F.lit("Unknown"))


def cross_key(url: Column, where: Column, title: Column) -> Column:
    """Key of one property across sources, tagged by kind; NULL never merges.

    ``where`` and ``title`` are the keys of address and name.
    """
    link = stripped(url)
    return (
        F.when(link.startswith(f"{KEY_MARK}addr:"), F.concat(F.lit("url:"), link))
        .when(is_street_key(where), F.concat(F.lit("addr:"), where))
        .when((title != "") & (where != ""), F.concat(F.lit("name_addr:"), title, F.lit(":"), where))
    )


def csv_safe(column: Column) -> Column:
    """Cell that no spreadsheet runs as a formula; NULL is empty."""
    text = said(column)
    return F.when(text.rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), text)).otherwise(text)


def clean_text(column: Column, most: int) -> Column:
    """Without control characters, white space collapsed, cut to ``most`` characters."""
    text = F.regexp_replace(stripped(column), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    text = stripped(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.rtrim(F.left(text, F.lit(most)))


def slug(column: Column, most: int) -> Column:
    """Lower case words joined by hyphens."""
    return F.left(F.regexp_replace(F.regexp_replace(F.lower(said(column)), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(most))


def fragment_url(base: Column, name: Column) -> Column:
    """Link to one property of a document: the base without fragment, and the name as fragment."""
    return F.concat(F.substring_index(base, "#", 1), F.lit("#"), slug(name, 48))


def name_from_slug(column: Column) -> Column:
    """Title of a document from the last part of its link, as words."""
    last = F.regexp_replace(F.element_at(F.split(F.regexp_replace(said(column), r"[?#].*$|/+$", ""), "/"), -1), r"(?i)\.pdf$", "")
    words = F.initcap(F.regexp_replace(last, r"[-_+]+|%20", " "))
    return stripped(F.regexp_replace(words, r"(?i)\b(\d{1,3}) ?(?:percent )?ami\b", "($1% AMI)"))


def header_slug(column: Column) -> Column:
    """Header cell as a field name."""
    return F.regexp_replace(F.regexp_replace(F.lower(stripped(column)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def header_field(column: Column) -> Column:
    """Field that a table header means; the first rule that fits counts; NULL if none."""
    h = header_slug(column)
    # Words of headers and the fields they stand for, in order.
    rules = (
        ("manager|management", "property_manager"),
        ("apartment|complex|property name", "property_name"),
        ("address", "address"),
        ("phone|telephone", "phone"),
        ("email|e_mail", "email"),
        ("occupancy", "occupancy_type"),
        ("community|population|type", "community_type"),
        ("bedroom|unit|br", "bedrooms"),
        ("support|service", "supportive_services"),
    )
    out = F.lit(None).cast("string")
    for words, name in reversed(rules):
        out = F.when(h.rlike(words), F.lit(name)).otherwise(out)
    return out


def contact_line(field: Column, notes: Column, mark: str) -> Column:
    """A contact field, else the first part of the notes that begins with ``mark``."""
    parts = F.filter(F.transform(F.split(said(notes), r"\|"), lambda p: F.trim(p)), lambda p: F.lower(p).startswith(mark))
    noted = F.trim(F.substr(F.try_element_at(parts, F.lit(1)), F.lit(len(mark) + 1)))
    return F.coalesce(F.nullif(stripped(field), F.lit("")), noted, F.lit(""))


def clipped(column: Column, most: int = 85) -> Column:
    """Text cut to ``most`` characters with dots behind it."""
    return F.when(F.length(column) > most, F.concat(F.left(column, F.lit(most)), F.lit("..."))).otherwise(column)


def key_label(authority: Column, name: Column, url: Column) -> Column:
    """Readable form of a listing's key."""
    head = F.concat(said(authority), F.lit(" — "), said(name))
    return F.when(said(url) != "", F.concat(head, F.lit(" ("), url, F.lit(")"))).otherwise(head)


def masked(column: Column) -> Column:
    """Secret with its first and last two characters only."""
    return F.when(F.length(column) <= 4, F.lit("****")).otherwise(
        F.concat(F.left(column, F.lit(2)), F.lit("****"), F.right(column, F.lit(2)))
    )


def iso_date(column: Column) -> Column:
    """First ISO date of a text; NULL if there is none or no such day."""
    return F.nullif(F.regexp_extract(said(column), r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")).try_cast("date")


def _renamed(old: str, new: str):
    return lambda m: F.when(m == old, new).otherwise(m)


def measures(column: Column, aliases: dict[str, str] | None = None) -> Column:
    """Tags of a list, lower case, each once, in order."""
    parts = F.filter(F.transform(F.split(F.lower(said(column)), ","), lambda m: F.trim(m)), lambda m: m != "")
    for old, new in (aliases or {"cdn": "civicplus"}).items():
        parts = F.transform(parts, _renamed(old, new))
    return F.array_distinct(parts)


# Hosts that are never fetched.
BLOCKED_HOSTS = ("localhost", "metadata.google.internal", "metadata")
BLOCKED_PARTS = (".local", ".internal", "169.254.")
_PRIVATE = (
    r"^(0\.|10\.|127\.|169\.254\.|192\.168\.|172\.(1[6-9]|2\d|3[01])\.|100\.(6[4-9]|[7-9]\d|1[01]\d|12[0-7])\."
    r"|192\.0\.0\.|192\.0\.2\.|198\.1[89]\.|198\.51\.100\.|203\.0\.113\.|22[4-9]\.|23\d\.|24\d\.|25[0-5]\.)"
)


def url_allowed(column: Column) -> Column:
    """Whether a link may be fetched, by its text: http(s), a host, no credentials, no private or blocked host."""
    url = stripped(column)
    host = F.lower(F.regexp_replace(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")), r"\.$", ""))
    ip = host.rlike(r"^\d{1,3}(\.\d{1,3}){3}$")
    blocked = host.isin(*BLOCKED_HOSTS) | host.startswith("[")
    for part in BLOCKED_PARTS:
        blocked = blocked | host.contains(part)
    return (
        url.rlike("^https?://")
        & (host != "")
        & F.try_parse_url(url, F.lit("USERINFO")).isNull()
        & ~blocked
        & ~(ip & host.rlike(_PRIVATE))
    )


def unwrapped_url(column: Column) -> Column:
    """Inner link of a document viewer's ``url`` parameter, else the link itself."""
    inner = F.try_url_decode(F.try_parse_url(column, F.lit("QUERY"), F.lit("url")))
    return F.when(inner.isNotNull() & url_allowed(inner), inner).otherwise(column)
