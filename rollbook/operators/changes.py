"""What a run means for each stored row, and what staff are told."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions import text as X
from rollbook.operators.canonical import KEY

LABELS = ("NEW", "UPDATED", "STALE", "SCRAPE_FAILED")
STALE_AFTER_DAYS = 7


def failed_labels(failed: DataFrame) -> DataFrame:
    """Failed sources under their raw and their canonical label: ``authority``."""
    return failed.select(F.explode(F.array("authority", X.authority_label(F.col("authority")))).alias("authority")).distinct()


def change_label(run_id: str, failed: Column) -> Column:
    """Label of a stored row after run ``run_id``; ``failed`` tells whether its source failed."""
    confirmed = F.trim(X.said(F.col("last_run_id"))) == run_id
    unknown_start = F.trim(X.said(F.col("first_run_id"))) == ""
    new = (F.col("first_run_id") == run_id) | (unknown_start & (F.col("first_seen") == F.col("last_seen")))
    return (
        F.when(confirmed & F.coalesce(new, F.lit(False)), "NEW")
        .when(confirmed, "UPDATED")
        .when(failed, "SCRAPE_FAILED")
        .otherwise("STALE")
    )


def change_label_by_time(now: str) -> Column:
    """Label where no run id is known: by first and last sight alone."""
    seen = F.col("last_seen").try_cast("timestamp_ntz")
    old = seen < F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {STALE_AFTER_DAYS} DAYS")
    return (
        F.when(F.col("first_seen") == F.col("last_seen"), "NEW")
        .when(F.coalesce(old, F.lit(False)), "STALE")
        .otherwise("UPDATED")
    )


def classify(inventory: DataFrame, run_id: str, failed: DataFrame, authorities: DataFrame | None = None) -> DataFrame:
    """Stored rows with ``change_type``; only those of ``authorities`` if given (a partial run)."""
    rows = inventory if authorities is None else inventory.join(authorities.select("authority").distinct(), "authority", "left_semi")
    marked = rows.join(failed_labels(failed).withColumn("failed", F.lit(True)), "authority", "left")
    return marked.withColumn("change_type", change_label(run_id, F.coalesce("failed", F.lit(False)))).drop("failed")


def label_counts(labelled: DataFrame) -> DataFrame:
    """``change_type, n`` with every label present."""
    spark = labelled.sparkSession
    every = spark.createDataFrame([(x,) for x in LABELS], "change_type string")
    return every.join(labelled.groupBy("change_type").agg(F.count("*").alias("n")), "change_type", "left").select(
        "change_type", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def last_by_key(rows: DataFrame, order: str = "seq") -> DataFrame:
    """The last row of each key."""
    return rows.groupBy(*KEY).agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*")


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Keys added, removed or of another status label: ``event, authority, property_name, url, old, new``.

    Status changes are told only where both snapshots have rows.
    """

    def labelled(df: DataFrame, name: str) -> DataFrame:
        return df.select(*KEY, X.status_label(F.col("listing_status"), F.col("status")).alias(name)).dropDuplicates(list(KEY))

    both = labelled(before, "old").join(labelled(after, "new"), list(KEY), "full_outer")
    return both.select(
        F.when(F.col("old").isNull(), "ADDED").when(F.col("new").isNull(), "REMOVED").when(F.col("old") != F.col("new"), "STATUS_CHANGE").alias("event"),
        *KEY,
        "old",
        "new",
    ).where("event IS NOT NULL")


def staff_events(labelled: DataFrame, previous_run: str | None, failed: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Events for staff: ``event, authority, property_name, url, old, new``.

    NEW rows are ADDED; a STALE row last seen in the previous good run is REMOVED
    unless its source failed; other STALE rows linger; status changes come from the
    two snapshots.
    """
    keys = labelled.join(failed_labels(failed).withColumn("bad", F.lit(True)), "authority", "left")
    gone = (F.col("change_type") == "STALE") & (F.col("last_run_id") == F.lit(previous_run)) & F.col("bad").isNull()
    event = (
        F.when(F.col("change_type") == "NEW", "ADDED")
        .when(F.col("change_type") == "SCRAPE_FAILED", "SCRAPE_FAILED")
        .when(F.coalesce(gone, F.lit(False)), "REMOVED")
        .when((F.col("change_type") == "STALE") & F.col("bad").isNull(), "STALE")
    )
    told = keys.select(event.alias("event"), *KEY, F.lit(None).cast("string").alias("old"), F.lit(None).cast("string").alias("new"))
    moved = snapshot_diff(before, after).where("event = 'STATUS_CHANGE'")
    return told.where("event IS NOT NULL").distinct().unionByName(moved)


def changelog(events: DataFrame, first_run: bool, skipped: DataFrame | None = None) -> DataFrame:
    """Events with their readable key; one INITIAL_RUN or NO_CHANGE row where there is nothing to compare or tell."""
    spark = events.sparkSession
    rows = events.select("event", X.key_label(F.col("authority"), F.col("property_name"), F.col("url")).alias("entry"), "old", "new")
    if first_run:
        rows = spark.createDataFrame([("INITIAL_RUN", "", None, None)], rows.schema)
    else:
        quiet = spark.createDataFrame([("NO_CHANGE", "", None, None)], rows.schema)
        some = rows.limit(1).select(F.lit(1).alias("one"))
        rows = rows.unionByName(quiet.join(some, F.lit(True), "left_anti"))
    if skipped is not None:
        rows = rows.unionByName(skipped.select(F.lit("SKIPPED").alias("event"), F.col("authority").alias("entry"), F.lit(None).cast("string").alias("old"), F.lit(None).cast("string").alias("new")))
    return rows
