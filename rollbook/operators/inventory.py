"""The stored inventory: merge, confirm, prune, export, and versions on disk."""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.files import Folder
from rollbook.functions import text as X
from rollbook.operators.canonical import KEY, LISTING, record_kind

STORED = [c for c in LISTING if c != "scrape_date"] + ["first_run_id", "last_run_id", "raw_data"]
INVENTORY_SCHEMA = ", ".join(f"{c} string" for c in STORED)
KEPT_FROM_OLD = ("first_seen", "first_run_id")
#: Days after which a row not seen counts as stale for pruning.
NOT_SEEN_DAYS = 45


def empty_inventory(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], INVENTORY_SCHEMA)


def incoming(rows: DataFrame, run_id: str) -> DataFrame:
    """Survivors in the stored shape, one for each key (the last by ``seq``)."""
    shaped = rows.where((F.col("authority") != "") & (F.col("property_name") != "")).select(
        *[F.col(c) for c in STORED if c in rows.columns],
        F.lit(run_id).alias("first_run_id"),
        F.lit(run_id).alias("last_run_id"),
        F.to_json(F.struct(*[c for c in rows.columns if c != "seq"])).alias("raw_data"),
        "seq",
    )
    return shaped.groupBy(*KEY).agg(F.max_by(F.struct(*STORED), "seq").alias("r")).select("r.*")


def merge(inventory: DataFrame, new: DataFrame) -> DataFrame:
    """Inventory after a run: new values win, first_seen and first_run_id stay.

    A full outer join on the key; merging the same run again changes nothing.
    """
    old = inventory.select(*[F.col(c).alias(f"old_{c}") for c in STORED], F.lit(True).alias("stored"))
    on = [new[c] == old[f"old_{c}"] for c in KEY]
    both = new.withColumn("came", F.lit(True)).join(old, on, "full_outer")

    def value(c: str) -> Column:
        if c in KEPT_FROM_OLD:
            return F.when(F.col("stored"), F.coalesce(f"old_{c}", c)).otherwise(F.col(c)).alias(c)
        return F.when(F.col("came"), F.col(c)).otherwise(F.col(f"old_{c}")).alias(c)

    return both.select(*[value(c) for c in STORED])


def merge_counts(inventory: DataFrame, new: DataFrame) -> DataFrame:
    """``inserted, updated``: how many new keys there are and how many were stored."""
    known = inventory.select(*KEY).distinct().withColumn("known", F.lit(True))
    return new.select(*KEY).join(known, list(KEY), "left").agg(
        F.count_if(F.col("known").isNull()).alias("inserted"), F.count_if(F.col("known")).alias("updated")
    )


def confirm(inventory: DataFrame, keys: DataFrame, run_id: str, now: str) -> DataFrame:
    """Inventory with last_run_id set for ``keys``; last_seen is filled only where missing, nothing is inserted."""
    hit = keys.select(*KEY).distinct().withColumn("hit", F.lit(True))
    marked = inventory.join(hit, list(KEY), "left")
    touched = {
        "last_run_id": F.when(F.col("hit"), F.lit(run_id)).otherwise(F.col("last_run_id")),
        "last_seen": F.when(F.col("hit") & F.col("last_seen").isNull(), F.lit(now)).otherwise(F.col("last_seen")),
    }
    return marked.select(*[touched.get(c, F.col(c)).alias(c) for c in STORED])


def prune_rule(
    today: str, not_seen_days: int | None = None, expires_past: bool = False, all_stale: bool = False, authority: str | None = None,
    text_expiry: bool = False,
) -> Column:
    """Rows to be removed: expired or not seen for long, of one authority if given. Without any rule no row.

    Expiry compares dates, so that rows without one stay; ``text_expiry`` compares
    texts, where an empty text counts as long past.
    """
    rules = []
    if expires_past or all_stale:
        rules.append(
            F.coalesce(F.col("expires_at") < F.lit(today), F.lit(False))
            if text_expiry
            else F.coalesce(F.col("expires_at").try_cast("date") < F.lit(today).cast("date"), F.lit(False))
        )
    if not_seen_days is not None or all_stale:
        days = NOT_SEEN_DAYS if not_seen_days is None else not_seen_days
        rules.append(F.coalesce(F.col("last_seen").try_cast("timestamp_ntz") < F.date_sub(F.lit(today).cast("date"), days).cast("timestamp_ntz"), F.lit(False)))
    if not rules:
        return F.lit(False)
    out = rules[0]
    for r in rules[1:]:
        out = out | r
    return out & (F.col("authority") == authority) if authority else out


def prune(inventory: DataFrame, rule: Column) -> DataFrame:
    return inventory.where(~rule)


def prune_from_diff(inventory: DataFrame, diff: DataFrame) -> DataFrame:
    """Inventory without the keys that a diff calls STALE."""
    stale = diff.where("change_type = 'STALE'").select(*KEY).distinct()
    return inventory.join(stale, list(KEY), "left_anti")


def export_full(inventory: DataFrame, run_id: str | None = None) -> DataFrame:
    """Current inventory for staff: sorted, with kind and whether this run confirmed it."""
    names = (
        "property_name address phone email bedrooms url status listing_status deadline income_limits unit_types eligibility_flags notes"
    ).split()
    later = (
        "confidence administrator administrator_url administrator_phone administrator_contact last_seen first_seen source source_url"
        " expires_at last_run_id"
    ).split()
    return inventory.select(
        F.col("authority").alias("source_authority"),
        *names,
        F.col("last_seen").alias("scrape_date"),
        *later,
        record_kind().alias("record_kind"),
        F.when(F.col("last_run_id") == F.lit(run_id), "Y").otherwise("N").alias("confirmed_this_run"),
    ).orderBy("source_authority", "property_name")


def export_diff(labelled: DataFrame) -> DataFrame:
    """Change rows for staff, sorted by label, authority and name."""
    names = (
        "property_name address phone email url status listing_status deadline bedrooms income_limits unit_types eligibility_flags"
        " confidence notes last_seen first_seen last_run_id source source_url expires_at"
    ).split()
    return labelled.select(
        "change_type", F.col("authority").alias("source_authority"), *names, record_kind().alias("record_kind")
    ).orderBy("change_type", "source_authority", "property_name")


class InventoryStore:
    """Versions of the inventory in a folder; a pointer file, replaced by rename, names the current one.

    Writing a new version never touches the one being read, and a failed write
    leaves the pointer as it was.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._files = Folder(spark, folder)
        self._files.make()

    def _path(self, *parts: str) -> str:
        return "/".join((self.folder, *parts))

    def _pointer(self) -> dict:
        return json.loads(self._files.read("CURRENT.json") or "{}")

    def read(self) -> DataFrame:
        current = self._pointer().get("version")
        return self.spark.read.schema(INVENTORY_SCHEMA).parquet(self._path(current)) if current else empty_inventory(self.spark)

    def write(self, inventory: DataFrame) -> str:
        version = f"v-{uuid.uuid4().hex}"
        inventory.select(*STORED).write.parquet(self._path(version))
        self._files.replace("CURRENT.json", json.dumps({"version": version}))
        return version

    def log_run(self, command: str, run_id: str, authority_filter: str | None, before: int, after: int, notes: str = "") -> None:
        """Appends to the run history."""
        row = [(datetime.now(UTC).replace(tzinfo=None), command, authority_filter, before, after, notes, run_id)]
        self.spark.createDataFrame(
            row, "timestamp timestamp_ntz, command string, authority_filter string, rows_before long, rows_after long, notes string, run_id string"
        ).write.mode("append").parquet(self._path("run_history"))

    def history(self, limit: int = 20) -> DataFrame:
        """The latest runs, newest first."""
        return self.spark.read.parquet(self._path("run_history")).orderBy(F.desc("timestamp")).limit(limit)

    def previous_full_run(self) -> str | None:
        """Id of the latest full run in the history."""
        if not self._files.exists("run_history"):
            return None
        row = (
            self.spark.read.parquet(self._path("run_history"))
            .where("command = '--run' AND authority_filter IS NULL")
            .agg(F.max_by("run_id", "timestamp").alias("run_id"))
            .first()
        )
        return row.run_id

    def snapshot(self, name: str, when: str, commit: str = "") -> str:
        """Copies the current version aside, with a manifest."""
        target = f"snapshots/{name}_{when}"
        rows = self.read()
        rows.write.mode("errorifexists").parquet(self._path(target, "data"))
        self._files.replace(f"{target}/manifest.json", json.dumps({"name": name, "time": when, "rows": rows.count(), "commit": commit}))
        return self._path(target)

    def snapshots(self) -> list[dict]:
        found = [(x, self._files.read(f"snapshots/{x}/manifest.json")) for x in self._files.names("snapshots", folders=True)]
        return [json.loads(text) | {"folder": x} for x, text in found if text]

    def restore(self, folder: str) -> str:
        """Makes a version put aside the current one again."""
        return self.write(self.spark.read.schema(INVENTORY_SCHEMA).parquet(self._path("snapshots", folder, "data")))

    def info(self) -> dict:
        return {"rows": self.read().count(), **self._pointer()}

    def drop(self, confirm: str) -> None:
        """Removes the whole inventory; only with the word DROP."""
        if confirm != "DROP":
            raise ValueError("dropping the inventory needs the word DROP")
        self._files.remove()
        self._files.make()

    def write_baseline(self, rows: DataFrame) -> None:
        """Stores what the next run is compared with."""
        rows.select(*BASELINE).write.mode("overwrite").parquet(self._path("baseline"))

    def baseline(self) -> DataFrame:
        path = self._path("baseline")
        if not self._files.exists("baseline"):
            return self.spark.createDataFrame([], ", ".join(f"{c} string" for c in BASELINE))
        return self.spark.read.parquet(path)


BASELINE = ("source_authority", "property_name", "url", "status", "listing_status")


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with safe cells, replaced whole by rename. For reports: the rows go through one task."""
    folder, _, name = path.rpartition("/")
    files, staged = Folder(df.sparkSession, folder or "."), f"{name}.{uuid.uuid4().hex}"
    safe = df.select(*[X.csv_safe(F.col(c).cast("string")).alias(c) for c in df.columns])
    safe.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{files.path}/{staged}")
    part = next(x for x in files.names(staged) if x.startswith("part-"))
    files.move(f"{staged}/{part}", name)
    files.remove(staged)


def read_csv(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """A CSV file with header; a missing file is an empty table of ``columns``."""
    folder, _, name = path.rpartition("/")
    if not Folder(spark, folder or ".").exists(name):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("quote", '"').csv(path).na.fill("")
