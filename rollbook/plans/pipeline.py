"""One run from raw records to stored inventory, labels, signals and reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.files import Folder
from rollbook.operators import canonical, changes, report, resolve, signals
from rollbook.operators import inventory as inv
from rollbook.session import cut


@dataclass
class RunResult:
    """What a run produced."""

    run_id: str
    inventory: DataFrame
    labelled: DataFrame
    events: DataFrame
    signals: DataFrame
    counts: DataFrame
    baseline_updated: bool


def run(
    store: inv.InventoryStore,
    raw: DataFrame,
    targets: DataFrame,
    outcomes: DataFrame,
    run_id: str,
    now: str,
    partial: DataFrame | None = None,
    mode: str = "exact",
    out: str | None = None,
) -> RunResult:
    """Canonicalises, removes duplicates, merges, labels and reports one run.

    ``outcomes`` has ``authority, had_error`` of the sources read. ``partial`` names
    the authorities of a partial run: only their rows are labelled, and neither
    run history nor baseline change. The baseline also stays where any source was
    unreliable, so that its missing rows are not called removed. Running the same
    run again gives the same inventory.
    """
    today = now[:10]
    before = cut(store.read())
    rows = cut(canonical.complete(canonical.canonical_rows(raw, now)))
    kept = cut(resolve.survivors(rows, mode))
    merged = inv.merge(before, inv.incoming(kept, run_id))
    merged = inv.confirm(merged, resolve.mirrors(rows, kept), run_id, now)
    merged = inv.confirm(merged, resolve.aliases(before, kept), run_id, now)
    after_path = store.write(merged)
    after = store.read()

    counts = signals.property_counts(canonical.with_raw_columns(raw).withColumn("authority", F.trim("authority")))
    failed = outcomes.where("had_error").select("authority")
    found = cut(signals.source_signals(targets, counts, failed, today))
    bad = signals.unreliable(found)
    everyone_failed = failed.unionByName(bad).distinct()
    labelled = cut(changes.classify(after, run_id, everyone_failed, partial))
    previous = store.previous_full_run()
    baseline = store.baseline()
    old = baseline.withColumnRenamed("source_authority", "authority")
    events = cut(changes.staff_events(labelled, previous, everyone_failed, old, after.select(*old.columns)))
    clean = partial is None and bad.isEmpty() and failed.isEmpty()
    if clean:
        store.log_run("--run", run_id, None, before.count(), after.count(), after_path)
        store.write_baseline(after.withColumnRenamed("authority", "source_authority"))
    if out:
        files = Folder(raw.sparkSession, out)
        files.make()
        suffix = "" if partial is None else "_partial"
        inv.write_csv(inv.export_full(after, run_id), f"{files.path}/current_full{suffix}.csv")
        inv.write_csv(inv.export_diff(labelled), f"{files.path}/diff{suffix}.csv")
        inv.write_csv(report.changelog_csv(events), f"{files.path}/changelog{suffix}.csv")
        skipped = targets.where(F.col("scraping_measures").ilike("%no_public_list%"))
        log = changes.changelog(events, previous is None and baseline.isEmpty(), skipped)
        candidates = report.summary_candidates(after).groupBy("authority").agg(F.count("*").alias("listings")).orderBy("authority")
        parts = [report.coverage(after), changes.label_counts(labelled), found.where("signal IS NOT NULL").orderBy("authority"), candidates]
        text = [f"# Run {run_id}", *[report.markdown_table(t) for t in parts], report.markdown_changelog(log)]
        files.replace(f"summary{suffix}.md", "\n\n".join(text) + "\n")
        if partial is None:
            files.replace("proposed_prune.md", report.prune_note(report.prune_proposal(labelled), run_id))
    return RunResult(run_id, after, labelled, events, found, changes.label_counts(labelled), clean)
