"""Duplicates of one run across sources: survivors, mirrors and aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions import text as X
from rollbook.operators.canonical import KEY
from rollbook.session import big, cut


def keyed(rows: DataFrame) -> DataFrame:
    """Rows with ``ident`` (their own key), ``cross`` (key across sources, may be NULL) and sortable ``rank``.

    rank is smaller for rows of higher confidence, then with contact, then with a
    link; ``seq`` breaks ties.
    """
    trust = (
        F.when(F.col("confidence") == "high", 0.9)
        .when(F.col("confidence") == "medium", 0.7)
        .when(F.col("confidence") == "low", 0.4)
        .otherwise(0.5)
    )
    contact = (X.said(F.col("phone")) != "") | (X.said(F.col("email")) != "")
    named = rows.withColumns({"_where": X.address_key(F.col("address")), "_title": X.name_key(F.col("property_name"))})
    return named.withColumns(
        {
            "ident": F.concat_ws("\u0001", *[X.said(F.col(c)) for c in KEY]),
            "cross": X.cross_key(F.col("url"), F.col("_where"), F.col("_title")),
            "rank": F.struct(
                (-trust).alias("trust"),
                (~contact).cast("int").alias("no_contact"),
                (X.said(F.col("url")) == "").cast("int").alias("no_link"),
                F.col("seq").alias("seq"),
            ),
        }
    )


def _lead(group: str) -> Column:
    return F.min("rank").over(Window.partitionBy(group))


def survivors_functional(rows: DataFrame) -> DataFrame:
    """Survivors where rows of one ident always have one cross key: two groupings suffice."""
    k = keyed(rows)
    # min(struct) aggregates before the shuffle; a window would gather hot keys.
    one = k.groupBy("ident").agg(F.min_by(F.struct(*k.columns), "rank").alias("r")).select("r.*")
    alone = one.where("cross IS NULL")
    shared = one.where("cross IS NOT NULL")
    best = shared.groupBy("cross").agg(F.min_by(F.struct(*shared.columns), "rank").alias("r")).select("r.*")
    return best.unionByName(alone).select(*rows.columns)


def survivors_exact(rows: DataFrame) -> DataFrame:
    """Survivors of the greedy scan in order of rank: a row is dropped if an accepted one has its ident or cross key.

    In rounds, on keys and ranks only: every row that leads both of its groups is
    accepted, rows that share a key with an accepted one go, until none is left; that
    equals the scan. Each round settles every row without a better undecided one
    beside it, so there are as many rounds as the longest chain of ever better rows.
    """
    k = cut(keyed(rows))
    left = k.select("ident", "cross", "rank")
    accepted: DataFrame | None = None
    while accepted is None or not left.isEmpty():
        lead_ident = left.groupBy("ident").agg(F.min("rank").alias("lead_ident"))
        lead_cross = left.where("cross IS NOT NULL").groupBy("cross").agg(F.min("rank").alias("lead_cross"))
        won = cut(
            left.join(big(lead_ident), "ident")
            .join(big(lead_cross), "cross", "left")
            .where((F.col("rank") == F.col("lead_ident")) & (F.col("lead_cross").isNull() | (F.col("rank") == F.col("lead_cross"))))
            .select("ident", "cross", "rank")
        )
        accepted = won if accepted is None else accepted.unionByName(won)
        left = cut(
            left.join(big(won.select("ident")), "ident", "left_anti").join(
                big(won.where("cross IS NOT NULL").select("cross").distinct()), "cross", "left_anti"
            ).select("ident", "cross", "rank")
        )
    return k.join(big(accepted.select("rank")), "rank", "left_semi").select(*rows.columns)


def survivors(rows: DataFrame, mode: str = "exact") -> DataFrame:
    """Rows of one run without cross-source duplicates; ``mode`` functional only where ident determines cross."""
    return survivors_functional(rows) if mode == "functional" else survivors_exact(rows)


def mirrors(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Keys of rows that did not survive: to be touched, not stored."""
    return rows.select(*KEY).distinct().join(big(kept.select(*KEY).distinct()), list(KEY), "left_anti")


def aliases(inventory: DataFrame, kept: DataFrame) -> DataFrame:
    """Keys of stored rows that are a survivor under another authority: same name, and same link or address.

    Two joins, on name and link and on name and address: a name that many rows have, or none, meets nothing by itself.
    """
    a = inventory.select(*[F.col(c).alias(f"i_{c}") for c in (*KEY, "address")])
    b = kept.select(*KEY, "address").distinct()
    other = (F.col("i_property_name") == F.col("property_name")) & (F.col("i_authority") != F.col("authority"))
    same = a.join(big(b.where("url != ''").select(*KEY).distinct()), other & (F.col("i_url") == F.col("url")))
    near = a.join(big(b.where(F.length("address") >= 8).select("authority", "property_name", "address").distinct()), other & (F.col("i_address") == F.col("address")))
    keys = [F.col(f"i_{c}").alias(c) for c in KEY]
    return same.select(*keys).unionByName(near.select(*keys)).distinct()
