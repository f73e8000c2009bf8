"""Web pages: cards, tables, links and lists read out of HTML in Arrow batches.

A small tree is built with the standard library's parser; a card rule names the
elements that hold one property and where its fields stand.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions import text as X

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements that end when another of them begins.
_SIBLINGS = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}, "option": {"option"}}


class Node:
    """An element of a page."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None = None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def text(self) -> str:
        parts: list[str] = []
        stack: list[Node | str] = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                parts.append(node)
            elif node.tag not in ("script", "style"):
                stack.extend(reversed(node.children))
        return re.sub(r"\s+", " ", " ".join(parts)).strip()

    def has_class(self, name: str) -> bool:
        return name in self.attrs.get("class", "").split()

    def select(self, rule: str) -> list[Node]:
        """Nodes inside that match ``tag``, ``tag.class``, ``.class`` or ``tag[attr=value]``; blanks nest rules."""
        found = [self]
        for step in rule.split():
            m = re.fullmatch(r"(\w*)(?:\.([\w-]+))?(?:\[([\w-]+)(?:([*^]?=)([^\]]+))?\])?", step)
            tag, cls, attr, how, value = m.groups()

            def fits(n: Node, tag=tag, cls=cls, attr=attr, how=how, value=value) -> bool:
                if tag and n.tag != tag or cls and not n.has_class(cls) or attr and attr not in n.attrs:
                    return False
                has = n.attrs.get(attr, "") if attr else ""
                return not how or {"=": has == value, "*=": value in has, "^=": has.startswith(value)}[how]

            found = list(dict.fromkeys(n for base in found for n in base.walk() if n is not base and fits(n)))
        return found


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.open = self.root

    def handle_starttag(self, tag, attrs):
        ends = _SIBLINGS.get(tag)
        if ends and self.open.tag in ends:
            self.open = self.open.parent or self.root
        node = Node(tag, {k: v or "" for k, v in attrs}, self.open)
        self.open.children.append(node)
        if tag not in _VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.open.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.open))

    def handle_endtag(self, tag):
        node = self.open
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:
            self.open = node.parent

    def handle_data(self, data):
        self.open.children.append(data)


def parse_html(text: str | None) -> Node:
    builder = _Builder()
    builder.feed(text or "")
    builder.close()
    return builder.root


PHONE = re.compile(r"\(?\b\d{3}\)?[\s.-]?\d{3}[\s.-]\d{4}\b")
EMAIL = re.compile(r"[\w.+'-]+@[\w-]+(?:\.[\w-]+)+")
UNITS = re.compile(r"\b(\d+)\s+(?:affordable\s+|available\s+)?units?\b", re.I)
CITY = re.compile(r"\b([A-Z][\w.'-]*(?: [A-Z][\w.'-]*)*),\s*(?:CA|California)\b")
STREET = re.compile(r"\b\d{1,6}\s+[A-Z][\w.'-]*(?:\s+[\w.'#-]+)*?(?:,\s*[\w. '-]+)*,\s*CA(?:\s+\d{5})?")

# Words of badges and what they stand for, the first that fits counts.
BADGES = {
    "alta": (("coming soon", "coming_soon"), ("wait", "waitlist"), ("closed", "closed"), ("no vacanc", "closed"), ("now leasing", "open"), ("available", "open")),
    "midpen": (("referral only", "closed"), ("interest list", "waitlist"), ("wait list closed", "closed"), ("waitlist closed", "closed"), ("wait", "waitlist"), ("coming soon", "coming_soon"), ("open", "open"), ("closed", "closed")),
    "eden": (("coming soon", "coming_soon"), ("wait list open", "waitlist"), ("waitlist open", "waitlist"), ("wait list closed", "closed"), ("closed", "closed"), ("open", "open"), ("leasing", "open")),
}
POPULATIONS = ("senior", "family", "special needs", "veteran", "supportive", "workforce", "disabled")


def badge(kind: str, text: str) -> str:
    low = text.lower()
    return next((status for words, status in BADGES[kind] if words in low), "")


def _first(node: Node, rule: str) -> Node | None:
    return next(iter(node.select(rule)), None)


def _text(node: Node, rule: str) -> str:
    found = _first(node, rule)
    return found.text() if found else ""


def _record(page: str, /, **fields: str) -> dict[str, str]:
    return {"source_url": page, **{k: v for k, v in fields.items() if v}}


def property_cards(root: Node, url: str) -> list[dict]:
    """A directory of boxes with flag, title and description; one for each link."""
    out, seen = [], set()
    for box in root.select("div.prop-box"):
        link = _first(box, ".prop-title a")
        href = urljoin(url, link.attrs.get("href", "")) if link else ""
        if not link or href in seen:
            continue
        seen.add(href)
        flag = _text(box, ".prop-flag")
        out.append(_record(url, property_name=link.text(), url=href, status=flag, listing_status=badge("alta", flag), address=_text(box, ".block-desc")))
    return out


def contact_cards(root: Node, url: str) -> list[dict]:
    """Cards with title link, address, mail and telephone links."""
    out = []
    for card in root.select("div.h_apart_ctc"):
        links = card.select("a")
        title = next((a for a in links if not re.match(r"(mailto|tel|javascript):", a.attrs.get("href", "")) and a.text()), None)
        if not title:
            continue
        by = {m[1]: a for a in links if (m := re.match(r"(mailto|tel|javascript):", a.attrs.get("href", "")))}
        where = re.sub(r",?\s*USA$", "", by["javascript"].text()) if "javascript" in by else ""
        out.append(
            _record(
                url, property_name=html.unescape(title.text()), url=urljoin(url, title.attrs.get("href", "")), address=where,
                email=by["mailto"].attrs["href"][7:] if "mailto" in by else "", phone=by["tel"].text() or by["tel"].attrs["href"][4:] if "tel" in by else "",
                unit_types=_text(card, ".unit-type"),
            )
        )
    return out


def location_cards(root: Node, url: str) -> list[dict]:
    """Cards that link to exactly one property; status flag, population and city by their words."""
    out, seen = [], set()
    for card in root.select("div.elementor-location-single"):
        links = [(urljoin(url, a.attrs["href"]), a) for a in card.select("a[href]") if "/property/" in a.attrs["href"] or "/properties/" in a.attrs["href"]]
        targets = list(dict.fromkeys(h for h, _ in links))
        if len(targets) != 1 or targets[0] in seen:
            continue
        seen.add(targets[0])
        text = card.text()
        city = CITY.findall(text)
        name = next((a.text() for _, a in links if a.text()), "")
        groups = [p for p in POPULATIONS if p in text.lower()]
        out.append(
            _record(url, property_name=name, url=targets[0], listing_status=badge("midpen", text), address=f"{city[-1]}, CA" if city else "", eligibility_flags="|".join(groups))
        )
    return out


def link_grid(root: Node, url: str) -> list[dict]:
    """Grid in which several links lead to one property: the first other text is its name, status words its status."""
    groups: dict[str, list[Node]] = {}
    for a in root.select("li a[href]"):
        groups.setdefault(urljoin(url, a.attrs["href"]), []).append(a)
    out = []
    for href, anchors in groups.items():
        texts = [a.text() for a in anchors if a.text()]
        name = next((t for t in texts if not badge("eden", t)), "")
        if not name:
            continue
        item = anchors[0]
        while item.parent and item.tag != "li":
            item = item.parent
        wide = item.text()
        for label in texts:
            wide = wide.replace(label, "|")
        flag = next((t for t in texts if badge("eden", t)), "")
        city, units = CITY.search(wide), UNITS.search(wide)
        out.append(
            _record(
                url, property_name=name, url=href, listing_status=badge("eden", flag or wide), status=flag, address=f"{city[1]}, CA" if city else "", unit_types=units[0] if units else ""
            )
        )
    return out


def heading_list(root: Node, url: str) -> list[dict]:
    """List of headings with link and an address paragraph."""
    out = []
    for item in root.select("li"):
        link = _first(item, "h2 a")
        if not link:
            continue
        where = re.sub(r",\s*California\b", ", CA", _text(item, "p"))
        city = CITY.search(where)
        out.append(_record(url, property_name=link.text(), url=urljoin(url, link.attrs.get("href", "")), address=where, city=city[1].split(",")[-1].strip() if city else ""))
    return out


def address_blocks(root: Node, url: str) -> list[dict]:
    """Blocks found by their street address; the name comes from the link's last part."""
    out, seen = [], set()
    for a in root.select("a[href]"):
        href = urljoin(url, a.attrs["href"])
        last = href.rstrip("/").rsplit("/", 1)[-1]
        if href in seen or not re.fullmatch(r"[a-z0-9]+(?:-[a-z0-9]+)+", last):
            continue
        node: Node | None = a.parent
        for _ in range(5):
            if node is None or node.tag == "#root":
                break
            if m := STREET.search(node.text()):
                text = node.text()
                phone, email = PHONE.search(text), EMAIL.search(text)
                seen.add(href)
                out.append(
                    _record(url, property_name=last.replace("-", " ").title(), url=href, address=m[0], phone=phone[0] if phone else "", email=email[0] if email else "")
                )
                break
            node = node.parent
    return out


def heading_boxes(root: Node, url: str) -> list[dict]:
    """Boxes with a heading, an address in the text, unit count and group words."""
    out, seen = [], set()
    for box in root.select("div.property-box"):
        name, text = _text(box, "h3"), box.text()
        where = STREET.search(text.replace(name, " ", 1))
        key = (name[:50].lower(), where[0][:50].lower() if where else "")
        if not name or key in seen:
            continue
        seen.add(key)
        units = UNITS.search(text)
        out.append(
            _record(
                url, property_name=name, address=where[0] if where else "", unit_types=units[0] if units else "", eligibility_flags="|".join(p for p in POPULATIONS if p in text.lower()),
                listing_status=badge("eden", text),
            )
        )
    return out


def availability_list(root: Node, url: str) -> list[dict]:
    """List items "Name - N available units" with contact text."""
    out = []
    for item in root.select("ul[role=presentation] li"):
        strong = _text(item, "strong")
        m = re.match(r"(.+?)\s*[-–—]\s*(\d+)\s+available", strong)
        if not m:
            continue
        text = item.text()
        phone, email = PHONE.search(text), EMAIL.search(text)
        out.append(_record(url, property_name=m[1].strip(), unit_types=f"{m[2]} available", phone=phone[0] if phone else "", email=email[0] if email else ""))
    return out


def labelled_page(root: Node, url: str) -> list[dict]:
    """A page of one property with labelled lines."""
    text = root.text()
    labels = ("Address", "Phone", "Email", "Unit Mix", "Income Limits", "Status", "Management")

    def after(label: str) -> str:
        others = "|".join(f"{x}:" for x in labels)
        m = re.search(rf"{label}:\s*(.+?)\s*(?={others}|$)", text)
        return m[1].strip(" |;") if m else ""

    def line_of(label: str) -> str:
        """The text of the element that begins with a label; what follows the element is not the label's."""
        for node in root.walk():
            own = node.text()
            if own.startswith(f"{label}:") and not any(f"{x}:" in own for x in labels if x != label):
                return own[len(label) + 1 :].strip(" |;")
        return after(label)

    name = _text(root, "h1") or _text(root, "title")
    if not name:
        return []
    files = [urljoin(url, a.attrs["href"]) for a in root.select("a[href]") if a.attrs["href"].lower().split("?")[0].endswith(".pdf")][:3]
    return [
        _record(
            url, property_name=name, url=url, address=after("Address"), phone=after("Phone"), email=after("Email"), unit_types=after("Unit Mix"), income_limits=after("Income Limits"),
            status=line_of("Status"), administrator=after("Management"), notes=" | ".join(files),
        )
    ]


PARSERS: dict[str, Callable[[Node, str], list[dict]]] = {
    "alta": property_cards,
    "charities_housing": contact_cards,
    "midpen": location_cards,
    "eden": link_grid,
    "eah": heading_list,
    "first_housing": address_blocks,
    "scc_boxes": heading_boxes,
    "availability": availability_list,
    "labelled": labelled_page,
}


def register_parser(tag: str, parser: Callable[[Node, str], list[dict]]) -> None:
    """Adds the parser of a further kind of page."""
    PARSERS[tag] = parser


def page_records(pages: DataFrame, kind: str | None = None) -> DataFrame:
    """Records of pages ``page_id, url, html`` and ``kind`` (or all of one kind): ``page_id, seq, record map``.

    Pages that hold nothing give no rows; a page that cannot be read does not fail the others.
    """
    source = pages if kind is None else pages.withColumn("kind", F.lit(kind))
    parsers = dict(PARSERS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for page, url, text, k in zip(pdf["page_id"], pdf["url"], pdf["html"], pdf["kind"]):
                if k in parsers and text:
                    rows += [(page, n, json.dumps(r)) for n, r in enumerate(parsers[k](parse_html(text), url or ""))]
            yield pd.DataFrame(rows, columns=["page_id", "seq", "record"])

    key = source.schema["page_id"].dataType.simpleString()
    out = source.select("page_id", "url", "html", "kind").mapInPandas(run, f"page_id {key}, seq long, record string")
    return out.select("page_id", "seq", F.from_json("record", "map<string,string>").alias("record"))


# Fixed value: how availability pages name a property and its free units.
_AVAILABLE = re.compile(r"([A-Z][A-Za-z][A-Za-z ]+?)\s*[-–]\s*(\d+)\s*available", re.IGNORECASE)


def links(pages: DataFrame) -> DataFrame:
    """Links of pages in order: ``page_id, seq, href, label, around``; around is the name before "- N available" in the nearest element that has one."""

    def named(a: Node) -> str:
        node: Node | None = a
        for _ in range(8):
            if node is None:
                break
            if m := _AVAILABLE.search(node.text()):
                return m[1].strip()
            node = node.parent
        return ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for page, url, text in zip(pdf["page_id"], pdf["url"], pdf["html"]):
                for n, a in enumerate(parse_html(text).select("a[href]")):
                    rows.append((page, n, urljoin(url or "", a.attrs["href"]), a.text(), named(a)))
            yield pd.DataFrame(rows, columns=["page_id", "seq", "href", "label", "around"])

    key = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInPandas(run, f"page_id {key}, seq long, href string, label string, around string")


def table_rows(pages: DataFrame) -> DataFrame:
    """Rows of HTML tables: ``page_id, seq, cells map`` by cleaned header, else ``col_<n>``; empty cells are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for page, text in zip(pdf["page_id"], pdf["html"]):
                n = 0
                for t in parse_html(text).select("table"):
                    lines = [[c.text() for c in tr.children if isinstance(c, Node) and c.tag in ("td", "th")] for tr in t.select("tr")]
                    names: list[str] = []
                    for k, line in enumerate(lines):
                        filled = [c for c in line if c]
                        if not k and filled:
                            # Several headers may stand in one cell.
                            names = [h.strip() for c in filled for h in re.split(r"[,/|&]|\s{2,}", c) if h.strip()]
                        elif filled:
                            heads = [names[j] if j < len(names) else f"col_{j}" for j in range(len(filled))]
                            rows.append((page, n, json.dumps({re.sub("[.,]", "", re.sub("[ /]", "_", h.lower())): c for h, c in zip(heads, filled)})))
                            n += 1
            yield pd.DataFrame(rows, columns=["page_id", "seq", "cells"])

    key = pages.schema["page_id"].dataType.simpleString()
    out = pages.select("page_id", "html").mapInPandas(run, f"page_id {key}, seq long, cells string")
    return out.select("page_id", "seq", F.from_json("cells", "map<string,string>").alias("cells"))


# Words of links that lead to documents, to flyers, and to what is no inventory.
DOCUMENT_HINTS = "documentcenter|.pdf|/docs/|viewfile"
FLYER_HINTS = "flyer|available|vacanc|lottery|rental|now-leasing"
NOISE_HINTS = "agenda|minutes|ordinance|budget|application-form|faq|privacy|policy|annual-report|newsletter|staff-report|brochure|map"
DOCUMENT_BUDGET = 15


def documents_to_read(found: DataFrame, budget: int = DOCUMENT_BUDGET) -> DataFrame:
    """Document links of each page in the order they should be read: ``page_id, href, nth, within_budget``.

    Each link once, noise dropped before anything is counted, flyers first. What
    lies beyond the budget is kept and marked, so that a cut is never silent.
    """
    from pyspark.sql import Window

    low = F.lower("href")
    rows = (
        found.where(low.rlike(DOCUMENT_HINTS) & ~low.rlike(NOISE_HINTS))
        .groupBy("page_id", "href")
        .agg(F.min("seq").alias("seq"))
        .withColumn("flyer", low.rlike(FLYER_HINTS))
    )
    order = Window.partitionBy("page_id").orderBy(F.desc("flyer"), "seq")
    return rows.withColumn("nth", F.row_number().over(order)).select("page_id", "href", "nth", (F.col("nth") <= budget).alias("within_budget"))


def flyer_names(found: DataFrame) -> DataFrame:
    """Name of each document link: its label's "Name - N available", else the words of the link: ``href, name``."""
    noted = F.regexp_extract("label", r"^(.+?)\s*[-–—]\s*\d+\s+available", 1)
    return found.groupBy("href").agg(F.max(noted).alias("noted")).select("href", X.first_said(F.col("noted"), X.name_from_slug(F.col("href"))).alias("name"))


def fill_names(records: DataFrame, names: DataFrame, least: int = 5) -> DataFrame:
    """Records whose name is shorter than ``least`` take the name of their document."""
    named = names.select(F.col("href").alias("document_url"), F.col("name").alias("document_name"))
    return records.join(named, "document_url", "left").withColumn(
        "property_name",
        F.when((F.length(X.said(F.col("property_name"))) < least) & F.col("document_name").isNotNull(), F.col("document_name")).otherwise(F.col("property_name")),
    ).drop("document_name")


def backfill(cards: DataFrame, rest: DataFrame) -> DataFrame:
    """Cards and those records of a second source whose link no card has."""
    return cards.unionByName(rest.join(cards.select("url").distinct(), "url", "left_anti"), allowMissingColumns=True)


def in_cities(records: DataFrame, cities: DataFrame) -> DataFrame:
    """Records of the given cities, case ignored; records without city drop out."""
    return records.where("city IS NOT NULL").withColumn("low", F.lower("city")).join(cities.select(F.lower("city").alias("low")).distinct(), "low", "left_semi").drop("low")


def route() -> F.Column:
    """Kind of page that a target's link and tags call for."""
    tags = X.measures(F.col("scraping_measures"))
    url = F.lower("url")
    out = F.lit(None).cast("string")
    for tag in ("first_housing", "eah", "eden", "midpen", "charities_housing", "alta"):
        out = F.when(F.array_contains(tags, tag), tag).otherwise(out)
    gis = F.when(url.endswith(".js"), "gis_script").when(url.contains("geojson"), "geojson").when(url.contains("arcgis"), "arcgis").otherwise("gis_page")
    stewart = F.when(url.contains("wp-json"), "jsco").when(url.contains("scc"), "scc_boxes").otherwise("labelled")
    return (
        F.when(F.arrays_overlap(tags, F.array(F.lit("waf_blocked"), F.lit("no_public_list"))), F.lit(None).cast("string"))
        .when(F.array_contains(tags, "gis"), gis)
        .when(F.array_contains(tags, "john_stewart"), stewart)
        .when(F.array_contains(tags, "bloom"), "bloom")
        .when(F.array_contains(tags, "pdf"), "pdf")
        .when(F.array_contains(tags, "civicplus"), "civicplus")
        .when(F.array_contains(tags, "housekeys"), "housekeys")
        .otherwise(out)
    )


def portal_rows(targets: DataFrame) -> DataFrame:
    """One pointer row for each target that only registers applicants elsewhere."""
    return targets.where(F.array_contains(X.measures(F.col("scraping_measures")), "housekeys")).select(
        "authority",
        F.concat(F.col("authority"), F.lit(" via HouseKeys")).alias("property_name"),
        X.first_said(F.col("administrator_url"), F.col("url")).alias("url"),
        F.lit("registration required").alias("status"),
        F.concat(F.lit("housekeys:"), X.slug(F.col("authority"), 40)).alias("source"),
        F.lit("HouseKeys").alias("administrator"),
        F.lit("Register with HouseKeys once; notices follow.").alias("notes"),
    )
