"""The list of sources: a pipe table in text, cleaned and loaded whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.functions import text as X

TARGET = (
    "authority url notes scraping_measures priority last_seen administrator administrator_url administrator_phone"
    " administrator_contact validated_zero validated_zero_review_due"
).split()
#: Header of each column, in the order that stands in where a header lacks it.
HEADERS = (
    "city/authority", "url", "notes", "scraping measures", "priority", "last seen", "administrator", "administrator url",
    "administrator phone", "administrator contact", "validated zero", "review due",
)
CRITICAL = ("city/authority", "url", "scraping measures")
# Longest texts kept.
LENGTHS = {"authority": 150, "notes": 800, "priority": 30, "last_seen": 30, "administrator": 200, "administrator_phone": 200, "administrator_contact": 200}
URL_LENGTH, ZERO_LENGTH = 2048, 40


class HeaderError(ValueError):
    """The table's header lacks a column that must not be guessed; nothing was replaced."""


def sanitize(raw: DataFrame) -> DataFrame:
    """Cleaned target rows: texts cut and stripped, unusable links and dates emptied, tags each once."""
    made = {c: X.clean_text(F.col(c), n) for c, n in LENGTHS.items()}
    for c in ("url", "administrator_url"):
        link = F.regexp_replace(X.stripped(F.col(c)), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
        made[c] = F.when(X.url_allowed(link), F.left(link, F.lit(URL_LENGTH))).otherwise("")
    tags = F.filter(F.split(F.lower(X.said(F.col("scraping_measures"))), "[,; ]+"), lambda t: t != "")
    made["scraping_measures"] = F.array_join(F.array_distinct(tags), ",")
    for c in ("validated_zero", "validated_zero_review_due"):
        text = X.clean_text(F.col(c), ZERO_LENGTH)
        made[c] = F.when(X.iso_date(text).isNull(), "").otherwise(text)
    return raw.select(*[made[c].alias(c) for c in TARGET])


def parse_table(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleaned targets of a pipe table, and ``authority, reason`` of rejected rows.

    ``lines`` has ``line`` and ``n``. The header is the first line that names
    City/Authority; a missing header or critical column raises before anything else
    happens. Rows with a bar in their notes or without usable link are rejected.
    """
    piped = lines.select("n", F.trim("line").alias("line")).where(F.contains("line", F.lit("|")))
    head = piped.where(F.contains("line", F.lit("City/Authority"))).orderBy("n").first()
    if head is None:
        raise HeaderError("no header with City/Authority")
    names = [c.strip().lower() for c in head.line.split("|") if c.strip()]
    missing = [c for c in CRITICAL if c not in names]
    if missing:
        raise HeaderError(f"header lacks {missing}")
    escaped = F.replace(F.col("line"), F.lit("\\|"), F.lit("\u0001"))
    cells = F.transform(F.split(F.regexp_replace(escaped, r"^\s*\||\|\s*$", ""), r"\|"), lambda c: F.trim(F.translate(c, "\u0001", "|")))
    rows = piped.where((F.col("n") > head.n) & ~F.col("line").rlike(r"^[|\s:-]+$")).select(cells.alias("cells"))

    def cell(k: int):
        at = names.index(HEADERS[k]) if HEADERS[k] in names else k
        return X.said(F.try_element_at("cells", F.lit(at + 1)))

    raw = rows.select(*[cell(k).alias(c) for k, c in enumerate(TARGET)])
    cleaned = sanitize(raw.where(~F.contains("notes", F.lit("|"))))
    rejected = raw.where(F.contains("notes", F.lit("|"))).select("authority", F.lit("bar in notes").alias("reason")).unionByName(
        cleaned.where("url = ''").select("authority", F.lit("no usable link").alias("reason"))
    )
    return cleaned.where("url != ''"), rejected


def read_table(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """:func:`parse_table` of a text file."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("n", "line"))
    return parse_table(lines)


def reload_targets(spark: SparkSession, path: str, target: str) -> int:
    """Replaces the stored targets by those of a file, after the file was read without error."""
    rows, _ = read_table(spark, path)
    rows.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target).count()


def ordered(targets: DataFrame) -> DataFrame:
    """Targets by priority as text, downwards, then authority."""
    return targets.orderBy(F.desc("priority"), F.asc("authority"))


def _skipped():
    return F.col("scraping_measures").ilike("%no_public_list%")


def active(targets: DataFrame) -> DataFrame:
    """Targets to be read; those without tags are."""
    return targets.where(F.col("scraping_measures").isNull() | ~_skipped())


def skipped(targets: DataFrame) -> DataFrame:
    return targets.where(_skipped())


def named(targets: DataFrame, wanted: str | None) -> DataFrame:
    """Targets whose authority contains a text, case ignored; blank takes all."""
    text = (wanted or "").strip().lower()
    return targets.where(F.contains(F.lower("authority"), F.lit(text))) if text else targets


def well_shaped(lines: DataFrame) -> DataFrame:
    """Table lines with 6 to 13 cells: ``n, ok``."""
    return lines.where(F.contains("line", F.lit("|"))).select("n", F.size(F.split(F.regexp_replace(F.trim("line"), r"^\||\|$", ""), r"\|")).between(6, 13).alias("ok"))
