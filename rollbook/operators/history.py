"""History of changing attributes: versions with the period each was valid.

A *reading* says that an entity had a value at a time. A *chain* is all versions
of one entity. Late or corrected readings change only the chains of the entities
they touch: those chains are rebuilt from raw readings and replaced whole.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.files import Folder
from rollbook.session import big, cut

CHAIN_COLUMNS = ("entity", "value", "valid_from", "valid_to")


def readings(
    raw: DataFrame, entity: str, value: str, seen: Column, first_seen: Column, received: str, order: Column
) -> DataFrame:
    """Raw updates in the operator's own columns, whatever else ``raw`` holds.

    ``entity, value, seen, first_seen, received, tie``: value is lower case and
    trimmed; blank values and unreadable times are NULL. Rows without entity are
    dropped. Extra columns are ignored.
    """
    text = F.lower(F.trim(F.col(value)))
    return raw.select(
        F.col(entity).alias("entity"),
        F.when(text != "", text).alias("value"),
        seen.alias("seen"),
        first_seen.alias("first_seen"),
        F.col(received).alias("received"),
        order.alias("tie"),
    ).where(F.col("entity").isNotNull())


def build_chains(read: DataFrame, bucket: str = "day") -> DataFrame:
    """Versions of every entity: ``entity, value, valid_from, valid_to``.

    A version is a longest stretch of readings, in order of ``seen``, that agree
    in value. Rows without value or time are no readings, but their ``first_seen``
    still counts for the first version's start. Of readings at the same second
    only the one received last counts (ties: larger ``tie``, then larger value).
    ``valid_to`` is NULL for the last version. No rows in, no rows out.

    One entity may hold any share of the rows: readings are first reduced to one
    for each entity and second (partial aggregation before the shuffle), then
    windows run over one entity's ``bucket`` of time, which holds at most so many
    readings as the bucket has seconds, and only bucket summaries are windowed by
    entity.
    """
    told = F.col("value").isNotNull() & F.col("seen").isNotNull()
    best = read.groupBy("entity", F.when(told, F.col("seen")).alias("seen")).agg(
        F.max(F.when(told, F.struct("received", "tie", "value"))).alias("last"), F.min("first_seen").alias("born")
    )
    # A bucket's readings in order, at most one for each second of it.
    inside = best.groupBy("entity", F.date_trunc(bucket, "seen").alias("bucket")).agg(
        F.array_sort(F.collect_list(F.when(F.col("seen").isNotNull(), F.struct("seen", F.col("last.value").alias("value"))))).alias("read"),
        F.min("born").alias("born"),
    )
    changes = F.filter("read", lambda x, i: (i == 0) | (x["value"] != F.get(F.col("read"), i - 1)["value"]))
    along = Window.partitionBy("entity").orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("entity").orderBy(F.col("bucket").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(F.get("read", F.size("read") - 1)["value"], ignorenulls=True).over(along)
    days = inside.select(
        "entity",
        "bucket",
        F.min("born").over(Window.partitionBy("entity")).alias("born"),
        carried.alias("carried"),
        changes.alias("changes"),
    ).withColumn(
        "starts", F.when(F.get("changes", F.lit(0))["value"] == F.col("carried"), F.expr("slice(changes, 2, size(changes))")).otherwise(F.col("changes"))
    )
    ahead = days.withColumn("next_start", F.last(F.get("starts", F.lit(0))["seen"], ignorenulls=True).over(back))
    return ahead.select("*", F.posexplode("starts").alias("i", "start")).select(
        "entity",
        F.col("start.value").alias("value"),
        F.when(F.col("carried").isNull() & (F.col("i") == 0), F.least("start.seen", "born")).otherwise(F.col("start.seen")).alias("valid_from"),
        F.coalesce(F.get("starts", F.col("i") + 1)["seen"], "next_start").alias("valid_to"),
    )


def touched_entities(batch: DataFrame) -> DataFrame:
    """The entities that a batch of readings touches."""
    return batch.select("entity").distinct()


def rebuild_affected(chains: DataFrame, raw: DataFrame, batch: DataFrame) -> DataFrame:
    """``chains`` after ``batch`` (late, corrected or new readings) came in.

    Takes the raw readings of touched entities only, earlier ones and the batch,
    rebuilds all their versions and replaces their chains whole; other chains pass
    through unread. An empty batch returns the chains as they are. Repeating a
    batch changes nothing.
    """
    touched = touched_entities(batch)
    again = build_chains(raw.join(big(touched), "entity", "left_semi").unionByName(batch))
    kept = chains.join(big(touched), "entity", "left_anti").select(*CHAIN_COLUMNS)
    return kept.unionByName(again)


def chains_after(raw: DataFrame, late: Column) -> DataFrame:
    """Chains of ``raw`` after its ``late`` readings came in on those built from the rest.

    What ``rebuild_affected`` gives, but earlier chains that the late readings
    replace are never built: one pass marks the readings of touched entities.
    """
    rows = cut(raw.withColumn("late", F.coalesce(late, F.lit(False))))
    touched = rows.where("late").select("entity").distinct().withColumn("touched", F.lit(True))
    marked = cut(rows.join(big(touched), "entity", "left"))
    kept = build_chains(marked.where("touched IS NULL"))
    return kept.unionByName(build_chains(marked.where("touched")))


class ChainStore:
    """Chains in a shared folder of any Hadoop file system; a new state becomes visible at once or not at all.

    Chains lie in ``buckets`` by their entity. A batch rewrites the buckets of the
    entities it touches, into files of their own; a small table of contents, replaced
    by one rename, says where each bucket lies now. Files that no table of contents names any
    longer go with ``vacuum``.
    """

    def __init__(self, spark, folder: str, buckets: int = 64):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        self._files = Folder(spark, folder)

    def contents(self) -> dict[str, str]:
        """Where each bucket lies now."""
        return json.loads(self._files.read("CURRENT.json") or "{}")

    def _read(self, places: list[str]) -> DataFrame | None:
        return self.spark.read.parquet(*[f"{self.folder}/{p}" for p in places]) if places else None

    def current(self) -> DataFrame | None:
        """All chains; None before the first batch."""
        return self._read(sorted(self.contents().values()))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("entity"), F.lit(self.buckets)).cast("int")

    def _publish(self, chains: DataFrame, touched: list[int], before: dict[str, str]) -> None:
        state = f"state-{uuid.uuid4().hex}"
        chains.withColumn("bucket", self._bucket()).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.folder}/{state}")
        now = {k: v for k, v in before.items() if int(k) not in touched}
        for k in touched:
            if self._files.exists(f"{state}/bucket={k}"):
                now[str(k)] = f"{state}/bucket={k}"
        self._files.replace("CURRENT.json", json.dumps(now))

    def apply(self, raw: DataFrame, batch: DataFrame) -> None:
        """Rebuilds what ``batch`` touches and publishes the new state; buckets without touched entities keep their files."""
        before = self.contents()
        touched = [r.k for r in batch.select(self._bucket().alias("k")).distinct().collect()]  # as many as buckets at most
        old = self._read([before[str(k)] for k in touched if str(k) in before])
        if old is None:
            again = build_chains(raw.join(big(touched_entities(batch)), "entity", "left_semi").unionByName(batch))
        else:
            again = rebuild_affected(old, raw, batch)
        self._publish(again, touched, before)

    def vacuum(self) -> int:
        """Removes files of earlier states; gives the number of folders removed. For times without readers."""
        used = set(self.contents().values())
        states = [s for s in self._files.names(folders=True) if s.startswith("state-")]
        old = [f"{s}/{one}" for s in states for one in self._files.names(s, folders=True) if f"{s}/{one}" not in used]
        for name in old:
            self._files.remove(name)
        return len(old)
