"""Queries of the language-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from rollbook.llm import canonical, leakage, linkage, mojibake, places, spellings, survivors, tokens
from rollbook.session import table


def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    """Free-typed authority and listing_status cells with the entry that is meant."""
    raw = table(spark, directory, "raw_records")
    return canonical.map_cells(
        raw, "record_id", "authority", table(spark, directory, "ref_authorities"), canonical.map_agencies
    ).unionByName(
        canonical.map_cells(
            raw, "record_id", "listing_status", table(spark, directory, "ref_statuses"), canonical.map_statuses
        )
    )


def p3_pairs(spark: SparkSession, directory: str) -> DataFrame:
    """Matching raw records and partner listings with the confidence of each match."""
    pairs = linkage.match_records(
        linkage.raw_side(table(spark, directory, "raw_records")),
        linkage.partner_side(table(spark, directory, "partner_listings")),
        table(spark, directory, "ref_authorities"),
    )
    return pairs.select(F.col("left_id").alias("record_id"), F.col("right_id").alias("partner_id"), "confidence")


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    """Matching raw records and partner listings."""
    return p3_pairs(spark, directory).select("record_id", "partner_id")


def p6_found(spark: SparkSession, directory: str) -> DataFrame:
    """Raw records at the same place with differing addresses."""
    return places.same_place(table(spark, directory, "raw_records"))


def p7_found(spark: SparkSession, directory: str) -> DataFrame:
    """Raw records that name one property of one authority in different spellings."""
    return spellings.same_property(
        table(spark, directory, "raw_records"), table(spark, directory, "ref_authorities")
    )


def p6_places(spark: SparkSession, directory: str) -> DataFrame:
    """Each raw record's place and number of links."""
    return places.place_classes(table(spark, directory, "raw_records"))


def p7_properties(spark: SparkSession, directory: str) -> DataFrame:
    """Each raw record's property by its name and number of linked wordings."""
    return spellings.name_classes(table(spark, directory, "raw_records"), table(spark, directory, "ref_authorities"))


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    """One surviving record for each mirror_key with two or more rows."""
    return survivors.surviving_records(table(spark, directory, "mirror_records"))


P4_SQL = r"""
WITH r AS (
  SELECT mirror_key, row_id,
    CASE lower(trim(confidence)) WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'low' THEN 3 ELSE 4 END AS lvl,
    date_trunc('second', try_cast(replace(trim(last_seen), 'Z', '') AS TIMESTAMP)) AS seen,
    regexp_replace(regexp_replace(lower(phone), '(\bx|\bext\b|\bextn\b|\bextension\b|#|([0-9])x|([0-9])ext)[\s.:#]*[0-9]+\s*$', '\2\3'), '[^0-9]', '', 'g') AS d,
    regexp_extract(lower(email), '[a-z0-9_%+''-]+(\.[a-z0-9_%+''-]+)*@[a-z0-9-]+(\.[a-z0-9-]+)*\.[a-z]{2,}') AS e
  FROM mirror_records WHERE trim(mirror_key) <> ''),
u AS (SELECT *, CASE WHEN length(d) = 11 AND d LIKE '1%' THEN substr(d, 2) ELSE d END AS p FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY mirror_key ORDER BY lvl, seen DESC NULLS LAST, row_id) AS n,
        CASE WHEN length(p) = 10 AND replace(p, substr(p, 1, 1), '') <> '' THEN p END AS phone,
        nullif(e, '') AS email FROM u)
SELECT mirror_key, coalesce(min_by(phone, n) FILTER (phone IS NOT NULL), '') AS phone,
  coalesce(min_by(email, n) FILTER (email IS NOT NULL), '') AS email,
  CASE min(lvl) WHEN 1 THEN 'high' WHEN 2 THEN 'medium' WHEN 3 THEN 'low' ELSE '' END AS confidence,
  coalesce(strftime(max(seen), '%Y-%m-%dT%H:%M:%S'), '') AS last_seen
FROM k GROUP BY mirror_key HAVING count(*) >= 2
"""


def p4_values(spark: SparkSession, directory: str) -> DataFrame:
    """Every usable phone and email of each mirror_key with the probability that it is true."""
    judged, _ = survivors.judged_values(table(spark, directory, "mirror_records"))
    return judged


def p4_sources(spark: SparkSession, directory: str) -> DataFrame:
    """Sensitivity and specificity of each source."""
    _, quality = survivors.judged_values(table(spark, directory, "mirror_records"))
    return quality


def p8_ids(spark: SparkSession, directory: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.encode_corpus(table(spark, directory, "documents"))


def p9_found(spark: SparkSession, directory: str) -> DataFrame:
    """Documents that leak a test item."""
    return leakage.leaks(table(spark, directory, "documents"), table(spark, directory, "eval_items")).select("doc_id", "item_id")


def p10_found(spark: SparkSession, directory: str) -> DataFrame:
    """Documents with text decoded in a wrong character set."""
    return mojibake.repaired(table(spark, directory, "documents")).select("doc_id")


def p10_restored(spark: SparkSession, directory: str) -> DataFrame:
    """Damaged documents with their most likely original text."""
    return mojibake.repaired(table(spark, directory, "documents"))


QUERIES = {
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p3_pairs": p3_pairs,
    "p4_found": p4_found,
    "p4_values": p4_values,
    "p4_sources": p4_sources,
    "p6_found": p6_found,
    "p6_places": p6_places,
    "p7_found": p7_found,
    "p7_properties": p7_properties,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p10_found": p10_found,
    "p10_restored": p10_restored,
}
SQL = {"p4_found": P4_SQL}
