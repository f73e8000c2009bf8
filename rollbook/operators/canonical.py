"""Raw records of any shape brought into one canonical row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions import text as X

#: Columns of a canonical row, all text; ``seq`` fixes the order of rows.
LISTING = (
    "authority property_name url address phone email deadline bedrooms income_limits unit_types eligibility_flags status"
    " listing_status notes confidence administrator administrator_url administrator_phone administrator_contact last_seen"
    " first_seen source source_url expires_at scrape_date"
).split()
RAW = [c for c in LISTING if c != "scrape_date"] + ["source_authority", "document_url", "scrape_date"]
KEY = ("authority", "property_name", "url")
# Names that are programs, not properties.
PROGRAM_NAMES = (
    "housing assistance",
    "rental housing",
    "unknown property",
    "los altos bmr rental program",
    "los altos bmr for-sale units",
    "los altos bmr for sale units",
)


def with_raw_columns(raw: DataFrame) -> DataFrame:
    """Every raw column, missing ones as NULL, lists joined by a bar; extra columns are dropped but ``seq``."""
    kinds = {f.name: f.dataType.typeName() for f in raw.schema.fields}

    def pick(name: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast("string").alias(name)
        if kinds[name] == "array":
            return F.array_join(F.col(name).cast("array<string>"), "|").alias(name)
        return F.col(name).cast("string").alias(name)

    seq = F.col("seq") if "seq" in kinds else F.monotonically_increasing_id()
    return raw.select(*[pick(c) for c in dict.fromkeys(RAW)], seq.cast("long").alias("seq"))


def canonical_rows(raw: DataFrame, now: str) -> DataFrame:
    """Canonical rows (``LISTING`` and ``seq``) of raw records.

    Rows that carry a scrape_date are canonical already and pass unchanged.
    Missing texts are empty. ``now`` stands in for missing times.
    """
    r = with_raw_columns(raw).withColumns({"_where": X.stripped(F.col("address")), "_label": X.authority_label(X.first_said(F.col("authority"), F.col("source_authority")))})
    r = r.withColumn("_key", X.address_key(F.col("_where")))

    def text(name: str) -> Column:
        return X.stripped(F.col(name))

    notes = text("notes")
    added = F.concat_ws(
        " | ",
        F.when((X.said(F.col("address")) != "") & ~F.contains(notes, F.col("address")), F.concat(F.lit("addr: "), "address")),
        *[
            F.when(X.said(F.col(c)) != "", F.concat(F.lit(f"{mark}: "), c))
            for c, mark in (("phone", "phone"), ("email", "email"), ("bedrooms", "br"))
        ],
    )
    full_notes = F.when(added == "", notes).otherwise(F.regexp_replace(F.concat(notes, F.lit(" | "), added), r"^[ |]+|[ |]+$", ""))
    made: dict[str, Column] = {c: text(c) for c in LISTING}
    made |= {
        "authority": F.col("_label"),
        "url": X.listing_url(
            X.stripped(X.first_said(F.col("url"), F.col("document_url"))),
            F.col("_where"),
            F.col("_key"),
            F.col("_label"),
            X.stripped(F.col("source_url")),
            X.stripped(F.col("property_name")),
        ),
        "unit_types": X.stripped(X.first_said(F.col("unit_types"), F.col("bedrooms"))),
        "eligibility_flags": X.said(F.col("eligibility_flags")),
        "status": X.status_label(F.col("listing_status"), F.col("status")),
        "listing_status": X.stripped(F.lower(X.said(F.col("listing_status")))),
        "notes": full_notes,
        "last_seen": X.first_said(F.col("last_seen"), F.lit(now)),
        "first_seen": X.first_said(F.col("first_seen"), F.lit(now)),
        "source_url": X.stripped(X.first_said(F.col("source_url"), F.col("document_url"))),
        "scrape_date": F.lit(now),
    }
    done = X.said(F.col("scrape_date")) != ""
    return r.select(*[F.when(done, F.col(c)).otherwise(made[c]).alias(c) for c in LISTING], "seq")


def complete(rows: DataFrame) -> DataFrame:
    """Rows with authority and name."""
    return rows.where((X.said(F.col("authority")) != "") & (X.said(F.col("property_name")) != ""))


def record_kind() -> Column:
    """portal, program or property."""
    source, low = F.lower(X.stripped(F.col("source"))), F.lower(X.stripped(F.col("property_name")))
    name = X.stripped(F.col("property_name"))
    return (
        F.when(source.startswith("housekeys:"), "portal")
        .when((F.lower(X.stripped(F.col("administrator"))) == "housekeys") | low.contains("via housekeys"), "portal")
        .when(
            (F.lower(X.stripped(F.col("status"))) == "registration required")
            & F.lower(X.said(F.col("notes"))).contains("housekeys"),
            "portal",
        )
        .when(low.isin(*PROGRAM_NAMES), "program")
        .when(
            (X.stripped(F.col("address")) == "")
            & (F.length(name) < 24)
            & (F.upper(name) == name)
            & (F.lower(name) != name)
            & name.contains(" "),
            "program",
        )
        .otherwise("property")
    )
