"""Signals on the quality of sources: suspicious zeros, low yield, reviews due."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions import text as X
from rollbook.operators.canonical import record_kind
from rollbook.operators.changes import failed_labels

# Tags of sources.
INFORMATIONAL = (
    "native_requests js_heavy table_based html_cards playwright_needed robots_respect delegated_administrator notification_based"
    " monitor_housing_element"
).split()
SKIP = ("waf_blocked", "no_public_list")
HANDLERS = "john_stewart gis housekeys civicplus alta charities_housing midpen eden eah first_housing".split()
INVENTORY = [h for h in HANDLERS if h != "housekeys"] + ["bloom", "pdf"]
PORTAL_ONLY = ("housekeys",)
# Least number of properties a source of each tag should give.
FLOORS = {
    "midpen": 25, "charities_housing": 28, "eden": 18, "eah": 14, "first_housing": 10, "bloom": 15, "gis": 10, "john_stewart": 15, "alta": 8,
}
LOW_YIELD = 3
STALE_WARNING = 5


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def expects_inventory(tags: Column) -> Column:
    """Whether a source with these tags should list properties."""
    real = F.array_except(tags, _array(INFORMATIONAL))
    return (
        ~F.arrays_overlap(tags, _array(SKIP))
        & (F.size(F.array_except(real, _array(PORTAL_ONLY))) > 0)
        & F.arrays_overlap(real, _array(INVENTORY))
    )


def floor_of(tags: Column) -> Column:
    """The highest floor of a source's tags, 0 if none has one."""
    floors = F.create_map(*[F.lit(x) for pair in FLOORS.items() for x in pair])
    return F.coalesce(F.array_max(F.transform(tags, lambda t: floors[t])), F.lit(0))


def property_counts(rows: DataFrame) -> DataFrame:
    """Number of property rows of each authority: ``authority, n``."""
    return rows.groupBy("authority").agg(F.count_if(record_kind() == "property").alias("n"))


def zero_state(noted: Column, due: Column, today: Column) -> Column:
    """none, current or due: whether an empty source has been looked at and until when that holds."""
    a, b = X.iso_date(noted), X.iso_date(due)
    return F.when(a.isNull() | b.isNull(), "none").when(today <= b, "current").otherwise("due")


def source_signals(
    targets: DataFrame, counts: DataFrame, failed: DataFrame, today: str, threshold: int = LOW_YIELD
) -> DataFrame:
    """One row for each target: ``authority, n, failed, zero_state, signal``.

    signal is suspicious_zero (nothing found where properties are expected and no
    zero is noted), low_yield (fewer than threshold or floor), reverification_due,
    or NULL. Failed sources give none of the first two.
    """
    tags = X.measures(F.col("scraping_measures"))
    bad = failed_labels(failed).withColumn("bad", F.lit(True))
    state = zero_state(F.col("validated_zero"), F.col("validated_zero_review_due"), F.lit(today).cast("date"))
    t = (
        targets.join(counts, "authority", "left")
        .withColumns({"n": F.coalesce("n", F.lit(0)).cast("long"), "tags": tags, "zero_state": state, "label": X.authority_label(F.col("authority"))})
        .join(bad.select(F.col("authority").alias("label"), "bad"), "label", "left")
        .withColumn("failed", F.coalesce("bad", F.lit(False)))
    )
    least = F.greatest(F.lit(max(0, threshold)), floor_of(F.col("tags")))
    signal = (
        F.when(~F.col("failed") & expects_inventory(F.col("tags")) & (F.col("zero_state") != "current") & (F.col("n") == 0), "suspicious_zero")
        .when(~F.col("failed") & (F.col("n") > 0) & (F.col("n") < least), "low_yield")
        .when(F.col("zero_state") == "due", "reverification_due")
    )
    return t.select("authority", "n", "failed", "zero_state", signal.alias("signal"))


def unreliable(signals: DataFrame) -> DataFrame:
    """Sources whose missing rows say nothing: failed, low or suspiciously empty; canonical labels, each once."""
    return (
        signals.where("failed OR signal IN ('suspicious_zero', 'low_yield')")
        .select(X.authority_label(F.col("authority")).alias("authority"))
        .distinct()
    )


def unreliable_in_order(signals: DataFrame) -> DataFrame:
    """The same sources in the order in which they are told, ``authority, nth``: failed ones, then low, then suspiciously empty; each once, at its first place. Sources are few."""
    told = F.when(F.col("failed"), 0).when(F.col("signal") == "low_yield", 1).when(F.col("signal") == "suspicious_zero", 2)
    each = signals.select(X.authority_label(F.col("authority")).alias("authority"), told.alias("told")).where("told IS NOT NULL")
    first = each.groupBy("authority").agg(F.min("told").alias("told"))
    return first.select("authority", F.row_number().over(Window.orderBy("told", "authority")).alias("nth"))


def needs_attention(signals: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: ``needs_attention``, true if any signal, failed row or enough stale rows."""
    flags = signals.agg(F.coalesce(F.bool_or(F.col("signal").isNotNull() | F.col("failed")), F.lit(False)).alias("a"))
    stale = labels.agg(
        F.coalesce(
            F.sum(F.when(F.col("change_type") == "SCRAPE_FAILED", F.col("n"))) > 0, F.lit(False)
        ).alias("b"),
        F.coalesce(F.sum(F.when(F.col("change_type") == "STALE", F.col("n"))) >= STALE_WARNING, F.lit(False)).alias("c"),
    )
    return flags.join(stale, F.lit(True)).select((F.col("a") | F.col("b") | F.col("c")).alias("needs_attention"))


def review_actions(signals: DataFrame, open_tasks: DataFrame) -> DataFrame:
    """Tasks to create or update: ``authority, signals, title, action``."""
    due = signals.where("signal IS NOT NULL").groupBy("authority").agg(F.array_sort(F.collect_set("signal")).alias("signals"))
    titled = due.withColumn("title", F.concat(F.lit("Re-verify source: "), "authority"))
    known = open_tasks.select("title").distinct().withColumn("known", F.lit(True))
    return titled.join(known, "title", "left").select("authority", "signals", "title", F.when(F.col("known"), "update").otherwise("create").alias("action"))


def bounds_check(counts: DataFrame, bounds: DataFrame) -> DataFrame:
    """Counts against known bounds: ``authority, n, inside``."""
    return bounds.join(counts, "authority", "left").select(
        "authority", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("n", F.lit(0)).between(F.col("least"), F.col("most")).alias("inside")
    )


def handler_drift(declared: DataFrame, registered: DataFrame) -> DataFrame:
    """Tags declared but not registered, and the other way: ``tag, missing``."""
    a = declared.select("tag").exceptAll(registered.select("tag")).withColumn("missing", F.lit("handler"))
    return a.unionByName(registered.select("tag").exceptAll(declared.select("tag")).withColumn("missing", F.lit("declaration")))
