"""Text of documents: pages, lines, tables and directories taken to records."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions import text as X

LINE_LEAST = 15
PHONE = r"\(?\d{3}\)?[-. ]?\d{3}[-. ]\d{4}"
EMAIL = r"[A-Za-z0-9._%+'-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
ADDRESS = r"\d{1,6}\s+(?:[NSEW]\.?\s+)?[A-Z][A-Za-z.'-]+(?:\s+[A-Z][A-Za-z.'-]+){0,3}\s+(?:Street|St|Avenue|Ave|Drive|Dr|Road|Rd|Boulevard|Blvd|Lane|Ln|Court|Ct|Place|Pl|Way|Circle|Cir|Terrace|Ter|Parkway|Pkwy)\b\.?"
# Words of header rows, and groups a property is for.
HEADER_WORDS = "apartment complex property address phone manager community bedroom email supportive".split()
COMMUNITIES = ("senior", "seniors", "family", "special needs", "veterans", "disabled", "homeless", "large family", "developmentally disabled")


def is_pdf(content: Column, content_type: Column) -> Column:
    """Whether bytes are a PDF: by their mark, or by their declared type unless they begin as HTML."""
    head = F.ltrim(F.decode(F.substring(content, 1, 64), "ISO-8859-1"))
    return head.startswith("%PDF-") | (F.contains(F.lower(X.said(content_type)), F.lit("pdf")) & ~head.startswith("<"))


def lines_of(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Lines of texts that are not empty, white space collapsed: ``<key>, n, line``."""
    rows = documents.select(key, F.posexplode(F.split(X.said(F.col(text)), r"\r?\n")).alias("n", "line"))
    return rows.select(key, "n", X.stripped(F.regexp_replace("line", r"(?U)\s+", " ")).alias("line")).where("line != ''")


def marked_lines(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Lines of recognised text with page rules: ``<key>, page, n, line``; headings dropped, table bars and bullets taken off."""
    pages = documents.select(key, F.posexplode(F.split(X.said(F.col(text)), r"\n-{48,}\n")).alias("page", "body"))
    rows = pages.select(key, "page", F.posexplode(F.split("body", "\n")).alias("n", "line")).where(~F.col("line").rlike(r"^\s*#"))
    flat = F.regexp_replace(F.regexp_replace("line", r"^\s*[-*•]\s+", ""), r"\s*\|\s*", " ")
    return rows.select(key, "page", "n", X.stripped(F.regexp_replace(flat, r"\s+", " ")).alias("line")).where(F.length("line") >= LINE_LEAST)


def line_records(lines: DataFrame, key: str) -> DataFrame:
    """Records of lines with phone, mail or address: ``<key>, n, property_name, address, phone, email, community_type, confidence``."""
    phone, email, address = (F.regexp_extract("line", f"({p})", 1) for p in (PHONE, EMAIL, ADDRESS))
    found = lines.where(F.length("line") >= LINE_LEAST).select(
        key, "n", "line", phone.alias("phone"), email.alias("email"), address.alias("address")
    ).where("phone != '' OR email != '' OR address != ''")
    first = F.when(F.col("address") != "", F.col("address")).when(F.col("phone") != "", F.col("phone")).otherwise(F.col("email"))
    name = F.regexp_replace(F.trim(F.call_function("substring_index", F.col("line"), first, F.lit(1))), r"[\s,;:–-]+$", "")
    low = F.lower("line")
    groups = F.filter(F.array(*[F.when(low.contains(c), F.lit(c)) for c in COMMUNITIES]), lambda c: c.isNotNull())
    longest = F.try_element_at(F.array_sort(F.transform(groups, lambda c: F.struct((-F.length(c)).alias("n"), c.alias("c")))), F.lit(1))["c"]
    signals = sum(((F.col(c) != "").cast("int") for c in ("phone", "email", "address", "property_name")), F.lit(0)) + F.col("community_type").isNotNull().cast("int")
    named = found.withColumns({"property_name": name, "community_type": longest})
    return named.select(
        key, "n", "property_name", "address", "phone", "email", "community_type",
        F.when(signals >= 4, "high").when(signals >= 2, "medium").otherwise("low").alias("confidence"),
    )


def is_header(cells: Column) -> Column:
    """Whether at least two of the header words stand in a row of cells."""
    text = F.lower(F.array_join(cells, " "))
    return sum((text.contains(w).cast("int") for w in HEADER_WORDS), F.lit(0)) >= 2


def table_records(rows: DataFrame, key: str) -> DataFrame:
    """Records of table rows ``<key>, n, cells array``: the header is the first fitting row of the first five.

    ``<key>, n, fields map, confidence``: fields by header, phone, mail and address
    also from the row's text; rows with fewer than two filled fields drop out.
    """
    heads = (
        rows.where((F.col("n") < 5) & is_header(F.col("cells")))
        .groupBy(key)
        .agg(F.min_by(F.struct("n", "cells"), "n").alias("h"))
        .select(key, F.col("h.n").alias("head"), F.transform("h.cells", X.header_field).alias("names"))
    )
    body = rows.join(heads, key).where(F.col("n") > F.col("head"))
    cells = F.transform("cells", lambda c: X.stripped(F.regexp_replace(X.said(c), r"\s+", " ")))
    pairs = F.filter(F.arrays_zip(F.col("names").alias("k"), cells.alias("v")), lambda p: p["k"].isNotNull() & (X.said(p["v"]) != ""))
    once = F.aggregate(
        pairs,
        F.create_map().cast("map<string,string>"),
        lambda acc, p: F.when(F.map_contains_key(acc, p["k"]), acc).otherwise(F.map_concat(acc, F.create_map(p["k"], p["v"]))),
    )
    text = F.array_join("cells", " ")
    found = body.select(key, "n", once.alias("fields"), text.alias("text"))
    for name, pattern in (("phone", PHONE), ("email", EMAIL), ("address", ADDRESS)):
        got = F.regexp_extract("text", f"({pattern})", 1)
        found = found.withColumn(
            "fields", F.when(~F.map_contains_key("fields", name) & (got != ""), F.map_concat("fields", F.create_map(F.lit(name), got))).otherwise(F.col("fields"))
        )
    n = F.size("fields")
    return found.where(n >= 2).select(key, "n", "fields", F.when(n >= 5, "high").when(n >= 3, "medium").otherwise("low").alias("confidence"))


def flyer_record(pages: DataFrame, key: str, text: str) -> DataFrame:
    """One record for each flyer: name, address, contacts, rents, deadline and income pairs by their patterns."""
    t = F.col("t")
    rows = pages.select(key, X.said(F.col(text)).alias("t"))
    return rows.select(
        key,
        X.stripped(F.regexp_extract(t, r"(?m)^\s*(\S.{3,80}?(?:Apartments|Homes|Village|Gardens|Court|Plaza|Terrace|Manor|Residences|Commons|Lofts|Studios|Townhomes|Housing))\b", 1)).alias("property_name"),
        F.regexp_extract(t, f"({ADDRESS})", 1).alias("address"),
        F.regexp_extract(t, f"({PHONE})", 1).alias("phone"),
        F.regexp_extract(t, f"({EMAIL})", 1).alias("email"),
        F.array_distinct(F.regexp_extract_all(t, F.lit(r"(\$\d[\d,]*)"), F.lit(1))).alias("amounts"),
        F.regexp_extract(t, r"(?i)(?:deadline|due|close[sd]?)\D{0,40}?(\d{4}-\d\d-\d\d|\d{1,2}/\d{1,2}/\d{2,4})", 1).alias("deadline"),
        F.array_distinct(F.regexp_extract_all(t, F.lit(r"(\d{2,3})% AMI"), F.lit(1))).alias("income_levels"),
    )


def best_tier(records: DataFrame, key: str) -> DataFrame:
    """Of each document the records of its first reading (``tier``, smallest first) that found any, without low ones."""
    good = records.where("confidence != 'low'")
    return good.withColumn("first", F.min("tier").over(Window.partitionBy(key))).where("tier = first").drop("first")


_CA = re.compile(r"\d{1,6} [^,]+, [A-Z][\w ]+, CA(?: \d{5})?")


def directory_records(pages: DataFrame, key: str, text: str, url: str) -> DataFrame:
    """Records of contact directories with two properties side by side: ``<key>, seq, property_name, address, phone, email, url``.

    A page counts as a directory with two addresses and the word BMR. Addresses of
    one line belong to the names of the line before; phones and mails follow in
    the order of the columns. "Coming soon" lines give rows of their own.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, t, u in zip(pdf["key"], pdf["text"], pdf["url"]):
                lines = [x.rstrip() for x in (t or "").split("\n")]
                if len(_CA.findall(t or "")) < 2 or "BMR" not in (t or ""):
                    continue
                n = 0
                for k, line in enumerate(lines):
                    if m := re.match(r"\s*(.+?)\s*[-–—]?\s*\(?coming soon\)?", line, re.I):
                        rows.append((i, n, m[1].strip(), "", "", "", u))
                        n += 1
                        continue
                    places = _CA.findall(line)
                    if not places:
                        continue
                    names = [x.strip() for x in re.split(r"\s{2,}", lines[k - 1].strip()) if x.strip()] if k else []
                    phones, mails = [], []
                    for later in lines[k + 1 : k + 5]:
                        if _CA.search(later):
                            break
                        phones += re.findall(PHONE, later)
                        mails += re.findall(EMAIL, later)
                    for j, place in enumerate(places):
                        name = names[j] if j < len(names) else ""
                        rows.append((i, n, name, place, phones[j] if j < len(phones) else "", mails[j] if j < len(mails) else "", u))
                        n += 1
            yield pd.DataFrame(rows, columns=["key", "seq", "property_name", "address", "phone", "email", "url"])

    kind = pages.schema[key].dataType.simpleString()
    out = pages.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(url).alias("url")).mapInPandas(
        run, f"key {kind}, seq long, property_name string, address string, phone string, email string, url string"
    )
    return out.where("property_name != ''").select(
        F.col("key").alias(key), "seq", "property_name", "address", "phone", "email", X.fragment_url(F.col("url"), F.col("property_name")).alias("url")
    )


def with_defaults(records: DataFrame, **defaults: Column) -> DataFrame:
    """Empty fields take their defaults."""
    return records.withColumns({c: X.first_said(F.col(c), d) if c in records.columns else d for c, d in defaults.items()})
