"""Queries of the general problems: attribute history (p1) and snapshot changes (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.functions.times import iso_second, iso_text
from rollbook.operators import history
from rollbook.operators.snapshots import snapshot_changes
from rollbook.session import table


def _status_readings(updates: DataFrame) -> DataFrame:
    return history.readings(
        updates,
        "listing_id",
        "listing_status",
        iso_second(F.col("last_seen")),
        iso_second(F.col("first_seen")),
        "received_at",
        F.col("update_id"),
    )


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    """Series of statuses of each listing: chains as of the day before the last
    delivery, then the affected chains rebuilt for what came on the last day."""
    raw = _status_readings(table(spark, directory, "listing_updates"))
    last = raw.agg(F.date_trunc("day", F.max("received")).alias("t")).first().t
    late = F.lit(False) if last is None else F.col("received") >= F.lit(last)
    chains = history.chains_after(raw, late)
    return chains.select(
        F.col("entity").cast("long").alias("listing_id"),
        F.col("value").alias("listing_status"),
        iso_text(F.col("valid_from")).alias("valid_from"),
        F.coalesce(iso_text(F.col("valid_to")), F.lit("")).alias("valid_to"),
    )


P1_SQL = """
WITH r AS (
  SELECT listing_id, update_id, received_at,
         nullif(lower(trim(listing_status)), '') AS st,
         date_trunc('second', try_cast(replace(trim(last_seen), 'Z', '') AS TIMESTAMP)) AS seen,
         date_trunc('second', try_cast(replace(trim(first_seen), 'Z', '') AS TIMESTAMP)) AS born
  FROM listing_updates WHERE listing_id IS NOT NULL),
one AS (
  SELECT listing_id, seen, st FROM (
    SELECT *, row_number() OVER (PARTITION BY listing_id, seen ORDER BY received_at DESC, update_id DESC, st DESC) AS n
    FROM r WHERE st IS NOT NULL AND seen IS NOT NULL) WHERE n = 1),
starts AS (
  SELECT listing_id, seen, st FROM (
    SELECT *, lag(st) OVER (PARTITION BY listing_id ORDER BY seen) AS before FROM one)
  WHERE before IS NULL OR before <> st),
v AS (
  SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY seen) AS n,
         lead(seen) OVER (PARTITION BY listing_id ORDER BY seen) AS nxt FROM starts),
b AS (SELECT listing_id, min(born) AS born FROM r GROUP BY 1)
SELECT listing_id, st AS listing_status,
       strftime(CASE WHEN n = 1 AND born < seen THEN born ELSE seen END, '%Y-%m-%dT%H:%M:%S') AS valid_from,
       coalesce(strftime(nxt, '%Y-%m-%dT%H:%M:%S'), '') AS valid_to
FROM v LEFT JOIN b USING (listing_id)
"""


def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    """Listings added, removed or changed in each full run since the run before."""
    return snapshot_changes(
        table(spark, directory, "inventory_snapshots"),
        table(spark, directory, "run_history"),
        table(spark, directory, "run_outcomes"),
    )


P5_SQL = """
WITH fr AS (SELECT DISTINCT run_id FROM run_history WHERE coalesce(trim(authority_filter), '') = ''),
au AS (SELECT DISTINCT authority FROM inventory_snapshots),
bad AS (SELECT DISTINCT run_id, authority FROM run_outcomes WHERE had_error),
ok AS (SELECT authority, run_id, lag(run_id) OVER (PARTITION BY authority ORDER BY run_id) AS prev
       FROM au CROSS JOIN fr LEFT JOIN bad USING (run_id, authority) WHERE NOT EXISTS (
         SELECT 1 FROM bad b WHERE b.run_id = fr.run_id AND b.authority = au.authority)),
p AS (SELECT run_id, listing_id, authority,
        max({'l': loaded_at, 'x': regexp_replace(lower(coalesce(property_name, '')), '\\s+', '', 'g') || '|' ||
             regexp_replace(lower(coalesce(listing_status, '')), '\\s+', '', 'g')}).x AS x
      FROM inventory_snapshots JOIN fr USING (run_id)
      WHERE date_trunc('second', try_cast(replace(trim(last_seen), 'Z', '') AS TIMESTAMP)) >= strptime(run_id, '%Y%m%dT%H%M%S')
      GROUP BY ALL),
now AS (SELECT ok.run_id, ok.prev, p.listing_id, p.x FROM ok JOIN p ON p.run_id = ok.run_id AND p.authority = ok.authority),
was AS (SELECT ok.run_id, p.listing_id, p.x FROM ok JOIN p ON p.run_id = ok.prev AND p.authority = ok.authority),
d AS (SELECT run_id, listing_id,
        CASE WHEN was.x IS NULL THEN 'ADDED' WHEN now.x IS NULL THEN 'REMOVED' WHEN was.x <> now.x THEN 'CHANGED' END AS change_type
      FROM now FULL JOIN was USING (run_id, listing_id))
SELECT run_id, listing_id, change_type FROM d
WHERE change_type IS NOT NULL AND run_id > (SELECT min(run_id) FROM fr)
"""


def p5_values(spark: SparkSession, directory: str) -> DataFrame:
    """Values before and after of every CHANGED listing."""
    return snapshot_changes(
        table(spark, directory, "inventory_snapshots"),
        table(spark, directory, "run_history"),
        table(spark, directory, "run_outcomes"),
        with_values=True,
    )


P5_VALUES_SQL = (
    P5_SQL[: P5_SQL.index("d AS (SELECT run_id")].replace("}).x AS x", ", 'n': property_name, 's': listing_status}) AS r").replace("p.x", "p.r").rstrip().rstrip(",")
    + """
SELECT run_id, listing_id, was.r.n AS property_name_before, was.r.s AS listing_status_before,
  now.r.n AS property_name_after, now.r.s AS listing_status_after
FROM now JOIN was USING (run_id, listing_id) WHERE was.r.x <> now.r.x AND run_id > (SELECT min(run_id) FROM fr)
"""
)


QUERIES = {"p1_found": p1_found, "p5_found": p5_found, "p5_values": p5_values}
SQL = {"p1_found": P1_SQL, "p5_found": P5_SQL, "p5_values": P5_VALUES_SQL}
