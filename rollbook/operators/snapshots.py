"""What changed between full snapshots of a table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.times import iso_second, run_start
from rollbook.session import big, cut, shuffle_width

#: Runs are metadata, one a day or so; their ids go to every task.
MAX_RUNS = 100_000
#: Rows of one hash bucket, about.
BUCKET_ROWS = 200_000


def folded(column: Column) -> Column:
    """Text without case and blanks; NULL is as good as empty."""
    return F.lower(F.regexp_replace(F.coalesce(column, F.lit("")), r"(?U)\s+", ""))


def _diff_sorted(old_keys, old_hash, new_keys, new_hash):
    """Set differences of two key arrays, both sorted and unique: masks of added, removed, changed."""
    at = np.searchsorted(old_keys, new_keys)
    inside = at < len(old_keys)
    both = np.zeros(len(new_keys), bool)
    both[inside] = old_keys[at[inside]] == new_keys[inside]
    changed = np.zeros(len(new_keys), bool)
    changed[both] = old_hash[at[both]] != new_hash[both]
    removed = np.ones(len(old_keys), bool)
    removed[at[both]] = False
    return ~both, removed, changed


def diff_bucket(pdf: pd.DataFrame, runs: list[int]) -> pd.DataFrame:
    """All runs of one hash bucket, as compact arrays.

    ``run`` (long form of the id), ``entity``, ``row_hash`` and ``fails`` (ids of
    the runs in which the entity's source failed, comma separated). ``before`` of the
    result is the run whose state a change is told from, 0 for added ones.
    """
    source, names = pd.factorize(pdf["fails"], use_na_sentinel=False)
    bad = [set(int(x) for x in (n or "").split(",") if x) for n in names]
    run, entity, row_hash = (pdf[c].to_numpy() for c in ("run", "entity", "row_hash"))
    order = np.lexsort((entity, run))
    run, entity, row_hash, source = run[order], entity[order], row_hash[order], source[order]
    edges = np.searchsorted(run, runs + [np.iinfo(np.int64).max])
    keys, hashes, sources, since = entity[:0], row_hash[:0], source[:0], run[:0]
    out_run, out_key, out_kind, out_before = [], [], [], []
    for k, this in enumerate(runs):
        silent = np.fromiter((this in b for b in bad), bool, len(bad))
        lo, hi = edges[k], np.searchsorted(run, this, side="right")
        told = ~silent[source[lo:hi]] if len(bad) else np.zeros(0, bool)
        new_keys, new_hashes, new_sources = entity[lo:hi][told], row_hash[lo:hi][told], source[lo:hi][told]
        waits = silent[sources] if len(sources) else np.zeros(0, bool)
        old_keys, old_hashes, old_since = keys[~waits], hashes[~waits], since[~waits]
        added, removed, changed = _diff_sorted(old_keys, old_hashes, new_keys, new_hashes)
        if k:
            were = old_since[np.searchsorted(old_keys, new_keys[changed])]
            for kind, found, told in (
                ("ADDED", new_keys[added], np.zeros(int(added.sum()), np.int64)), ("REMOVED", old_keys[removed], old_since[removed]), ("CHANGED", new_keys[changed], were)
            ):
                out_run.append(np.full(len(found), this, np.int64))
                out_key.append(found)
                out_before.append(told)
                out_kind.append(np.full(len(found), kind, object))
        # Sources that said nothing keep the state before; a key told anew leaves it.
        still = waits & ~np.isin(keys, new_keys)
        keys = np.concatenate([keys[still], new_keys])
        hashes = np.concatenate([hashes[still], new_hashes])
        sources = np.concatenate([sources[still], new_sources])
        since = np.concatenate([since[still], np.full(len(new_keys), this, np.int64)])
        by_key = np.argsort(keys, kind="stable")
        keys, hashes, sources, since = keys[by_key], hashes[by_key], sources[by_key], since[by_key]
    if not out_run:
        return pd.DataFrame({"run": [], "entity": [], "change_type": [], "before": []})
    return pd.DataFrame(
        {"run": np.concatenate(out_run), "entity": np.concatenate(out_key), "change_type": np.concatenate(out_kind), "before": np.concatenate(out_before)}
    )


def full_runs(run_history: DataFrame) -> list[str]:
    """Ids of the full runs in order; partial ones carry an authority_filter."""
    found = (
        run_history.where(F.trim(F.coalesce("authority_filter", F.lit(""))) == "")
        .where(run_start(F.col("run_id")).isNotNull())
        .select(F.trim("run_id").alias("run_id"))
        .distinct()
        .limit(MAX_RUNS + 1)
        .collect()
    )
    if len(found) > MAX_RUNS:
        raise ValueError(f"more than {MAX_RUNS} runs: split the history")
    return sorted(r.run_id for r in found)


def _as_long(run_id: Column) -> Column:
    return F.translate(run_id, "T", "").cast("long")


def snapshot_changes(
    snapshots: DataFrame,
    run_history: DataFrame,
    run_outcomes: DataFrame,
    entity: str = "listing_id",
    watched: tuple[str, ...] = ("property_name", "listing_status"),
    with_values: bool = False,
) -> DataFrame:
    """Changes between consecutive full snapshots: ``run_id, <entity>, change_type``.

    An entity is present in a run that has a row of it with last_seen not before
    the run's start; of several such rows the one loaded last counts (ties: the
    larger row hash). Where its source failed in a run nothing is said, and the next run is
    compared with the state before. Case and blanks make no change; NULL equals
    empty. Rows without entity, or with a NULL or unreadable last_seen, are not
    present; sources without an outcome did not fail. Empty tables give no rows;
    extra columns are ignored.

    Rows shrink to key and row hash at the scan and to one for each run and entity
    before the shuffle, so hot entities and sources are harmless; hash buckets of
    entities are then compared with sorted arrays. With ``with_values`` the full
    rows of changed keys alone are fetched again, as ``<column>_before`` and
    ``<column>_after``.
    """
    spark = snapshots.sparkSession
    runs = full_runs(run_history)
    known = {int(r.replace("T", "")): r for r in runs}
    longs = sorted(known)
    failed = (
        run_outcomes.where("had_error")
        .select(F.col("authority").alias("source"), _as_long(F.trim("run_id")).alias("run"))
        .join(F.broadcast(spark.createDataFrame([(r,) for r in longs], "run long")), "run", "left_semi")  # MAX_RUNS rows at most
    )
    fails = failed.groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("run")), ",").alias("fails"))
    seen = iso_second(F.col("last_seen"))
    full = F.broadcast(spark.createDataFrame([(r,) for r in runs], "run_id string"))  # MAX_RUNS rows at most
    present = snapshots.join(full, "run_id", "left_semi").where(F.col(entity).isNotNull() & (seen >= run_start(F.col("run_id"))))
    compact = present.select(
        _as_long(F.col("run_id")).alias("run"),
        F.col(entity).cast("long").alias("entity"),
        F.col("authority").alias("source"),
        "loaded_at",
        F.xxhash64(*[folded(F.col(c)) for c in watched]).alias("row_hash"),
    )
    latest = (
        compact.groupBy("run", "entity")
        .agg(F.max(F.struct("loaded_at", "row_hash", "source")).alias("last"))
        .select("run", "entity", F.col("last.row_hash").alias("row_hash"), F.col("last.source").alias("source"))
        .join(fails, "source", "left")
        .select("run", "entity", "row_hash", F.coalesce("fails", F.lit("")).alias("fails"))
    )
    # Buckets of a bounded size, however many rows there are; an entity has one row for each run at most.
    width = max(shuffle_width(spark), -(-snapshots.count() // BUCKET_ROWS))
    changes = latest.groupBy(F.pmod(F.xxhash64("entity"), F.lit(width)).alias("bucket")).applyInPandas(
        lambda pdf: diff_bucket(pdf, longs), "run long, entity long, change_type string, before long"
    )
    named = changes.select(_as_id(F.col("run")).alias("run_id"), F.col("entity").alias(entity), "change_type", _as_id(F.col("before")).alias("_before"))
    if not with_values:
        return named.drop("_before")
    return _with_values(named.where("change_type = 'CHANGED'").drop("change_type"), present, entity, watched)


def _as_id(run: Column) -> Column:
    return F.regexp_replace(run.cast("string"), r"^(\d{8})(\d{6})$", "$1T$2")


def _with_values(changed: DataFrame, present: DataFrame, entity: str, watched: tuple[str, ...]) -> DataFrame:
    """Values of changed keys in their run and in the run whose state they are compared with; only those rows travel."""
    changed = cut(changed)
    keys = changed.select(entity, F.explode(F.array("run_id", "_before")).alias("run_id")).distinct()
    rows = (
        present.join(keys, [entity, "run_id"], "left_semi")
        .groupBy(entity, "run_id")
        .agg(F.max(F.struct("loaded_at", F.xxhash64(*[folded(F.col(c)) for c in watched]).alias("h"), *watched)).alias("row"))
    )
    now = rows.select(entity, "run_id", *[F.col(f"row.{c}").alias(f"{c}_after") for c in watched])
    was = rows.select(entity, F.col("run_id").alias("_before"), *[F.col(f"row.{c}").alias(f"{c}_before") for c in watched])
    return changed.join(big(was), [entity, "_before"]).join(big(now), [entity, "run_id"]).select(
        "run_id", entity, *[f"{c}_before" for c in watched], *[f"{c}_after" for c in watched]
    )
