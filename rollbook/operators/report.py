"""Sections of reports as tables, and their text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions import text as X
from rollbook.operators.canonical import record_kind

TOP = 100


def coverage(rows: DataFrame) -> DataFrame:
    """``total, properties, portals, programs`` of rows."""
    kind = record_kind()
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(kind == "property").alias("properties"),
        F.count_if(kind == "portal").alias("portals"),
        F.count_if(kind == "program").alias("programs"),
    )


def first_of_each(rows: DataFrame, classes: str | None = None, order: str = "seq") -> DataFrame:
    """The first row of each name (55 characters, case ignored) and authority, inside each class."""
    keys = {"k_name": F.lower(X.stripped(F.left("property_name", F.lit(55)))), "k_authority": X.said(F.col("authority"))}
    if classes:
        keys["k_class"] = F.col(classes)
    keyed = rows.withColumns(keys)
    return keyed.groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), order).alias("r")).select("r.*")


def top_and_rest(rows: DataFrame, order: list, most: int = TOP) -> tuple[DataFrame, DataFrame]:
    """The first ``most`` rows, and the number of the others."""
    return rows.orderBy(*order).limit(most), rows.agg(F.greatest(F.count("*") - most, F.lit(0)).alias("more"))


def run_figures(outcomes: DataFrame) -> DataFrame:
    """``run_id, attempted, failed, succeeded`` of each run."""
    return outcomes.groupBy("run_id").agg(
        F.count("*").alias("attempted"), F.count_if("had_error").alias("failed"), F.count_if(~F.coalesce("had_error", F.lit(False))).alias("succeeded")
    )


def last_good_runs(outcomes: DataFrame, history: DataFrame) -> DataFrame:
    """Each full run with the full run before it: ``run_id, previous``. Runs are few."""
    full = history.where(F.coalesce(F.trim("authority_filter"), F.lit("")) == "").select("run_id").distinct()
    known = full.join(outcomes.select("run_id").distinct(), "run_id", "left_semi")
    return known.select("run_id", F.lag("run_id").over(Window.orderBy("run_id")).alias("previous"))


def markdown_table(df: DataFrame, most: int = TOP) -> str:
    """A short table as text; for reports only, at most ``most`` rows come to the driver."""
    rows = df.limit(most).collect()
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in rows])


def markdown_changelog(changes: DataFrame, most: int = TOP) -> str:
    """Events grouped under headings, entries in order."""
    out = []
    for event in ("INITIAL_RUN", "ADDED", "REMOVED", "STATUS_CHANGE", "STALE", "SCRAPE_FAILED", "SKIPPED", "NO_CHANGE"):
        part = changes.where(F.col("event") == event)
        rows, more = top_and_rest(part, ["entry"], most)
        found = rows.collect()
        if not found:
            continue
        out.append(f"## {event.replace('_', ' ').title()}")
        out += [f"- {r.entry}" + (f": {r.old} → {r.new}" if r.old or r.new else "") if r.entry else "- no listings to compare" for r in found]
        rest = more.first().more
        if rest:
            out.append(f"- and {rest} more")
    return "\n".join(out)


# How names begin that a page's navigation left.
NAVIGATION = ("quick links", "skip to", "home /", "your city /", "in this section", "select this as", "housing open side", "/ your city")


def summary_candidates(rows: DataFrame) -> DataFrame:
    """Rows that a summary may list: properties whose name is neither closed nor navigation, and longer than four letters unless their source is structured."""
    name = F.lower(X.said(F.col("property_name")))
    navigation = F.exists(F.array(*[F.lit(p) for p in NAVIGATION]), lambda p: F.startswith(name, p))
    structured = F.contains(X.said(F.col("source")), F.lit(":"))
    return rows.where((record_kind() == "property") & ~name.contains("closed") & ~navigation & (structured | (F.length("property_name") > 4)))


def rekeyed(diff: DataFrame) -> DataFrame:
    """Rows of a change export under the key of the inventory: ``authority, property_name, url`` and the rest."""
    label = X.first_said(F.col("source_authority"), F.col("authority")) if "authority" in diff.columns else X.said(F.col("source_authority"))
    rest = [c for c in diff.columns if c not in ("source_authority", "authority", "property_name", "url")]
    return diff.select(label.alias("authority"), X.said(F.col("property_name")).alias("property_name"), X.said(F.col("url")).alias("url"), *rest)


def prune_proposal(labelled: DataFrame) -> DataFrame:
    """What pruning after a run could take, by source: ``authority, stale, failed``; rows of failed sources are not gone and never proposed."""
    return labelled.groupBy("authority").agg(
        F.count_if(F.col("change_type") == "STALE").alias("stale"), F.count_if(F.col("change_type") == "SCRAPE_FAILED").alias("failed")
    )


def prune_note(proposal: DataFrame, run_id: str) -> str:
    """The proposal as a note for operators; nothing is removed by it."""
    total = proposal.agg(F.coalesce(F.sum("stale"), F.lit(0)).alias("stale"), F.coalesce(F.sum("failed"), F.lit(0)).alias("failed")).first()
    head = [f"# Rows that run {run_id} did not confirm", "", f"- to be looked at: {total.stale}", f"- of failed sources, not to be pruned: {total.failed}", ""]
    return "\n".join(head + ([markdown_table(proposal.where("stale > 0").orderBy("authority"))] if total.stale else ["Nothing to prune."]))


def changelog_csv(changes: DataFrame) -> DataFrame:
    """Change log rows for a file: ``change_type, authority, property_name, url, details``."""
    told = F.when((X.said(F.col("old")) != "") | (X.said(F.col("new")) != ""), F.concat(X.said(F.col("old")), F.lit(" → "), X.said(F.col("new")))).otherwise("")
    return changes.select(F.col("event").alias("change_type"), "authority", "property_name", "url", told.alias("details"))


def link_of(*columns: str) -> F.Column:
    """The first link a listing has."""
    return X.first_said(*[F.col(c) for c in columns])
