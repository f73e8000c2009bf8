"""One surviving record for each group of duplicates, filled field by field.

Two ways. :func:`surviving_records` ranks the rows of a group by a fixed trust order
and takes each field's first usable value. :func:`judged_values` is a latent
two-sided quality model: each source has a sensitivity (it states a true value) and
a specificity (it does not state a false one), inferred with the truth of every
value by expectation-maximisation; a field keeps every value judged true.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.times import iso_second, iso_text
from rollbook.session import big, cut

LEVELS = ("high", "medium", "low")
#: Sources are few (adapters, feeds); their quality numbers fit the driver.
MAX_SOURCES = 10_000
#: Trust put in every source beforehand, as sensitivity and specificity, and its weight as a share of what the source is judged by.
TRUST, TRUST_SHARE = 0.8, 0.25


def usable_phone(column: Column) -> Column:
    """Ten digits, once extension and leading country code are dropped and unless all are equal; else NULL."""
    bare = F.regexp_replace(F.lower(column), r"(?:\bx|\bext\b|\bextn\b|\bextension\b|#|(?<=\d)x|(?<=\d)ext)[\s.:#]*\d+\s*$", "")
    digits = F.regexp_replace(bare, r"\D", "")
    ten = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).otherwise(digits)
    return F.when(ten.rlike(r"^\d{10}$") & ~ten.rlike(r"^(\d)\1{9}$"), ten)


def usable_email(column: Column) -> Column:
    """A whole name@host.domain in lower case, bare; else NULL."""
    found = F.regexp_extract(
        F.lower(column), r"(?<![a-z0-9._%+'-])([a-z0-9_%+'-]+(?:\.[a-z0-9_%+'-]+)*@[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,})(?![a-z0-9@_-])", 1
    )
    return F.nullif(found, F.lit(""))


def level_of(column: Column) -> Column:
    """1 for high, 2 medium, 3 low, 4 for anything else or missing."""
    text = F.lower(F.trim(column))
    out = F.lit(4)
    for k, name in enumerate(LEVELS, 1):
        out = F.when(text == name, k).otherwise(out)
    return out


def surviving_records(
    records: DataFrame,
    group: str = "mirror_key",
    row: str = "row_id",
    phone: str = "phone",
    email: str = "email",
    confidence: str = "confidence",
    last_seen: str = "last_seen",
) -> DataFrame:
    """One row for each group of two or more rows: ``<group>, phone, email, confidence, last_seen``.

    Rows rank by confidence (high, medium, low, anything else), later last_seen,
    smaller row id; each field takes its first usable value in that order, ``''``
    if there is none. confidence and last_seen are the group's best and latest.
    Rows without group are left out; unreadable times rank last. One aggregation
    with partial results before the shuffle, so a hot group is never gathered.
    """
    seen = iso_second(F.col(last_seen))
    rank = (
        level_of(F.col(confidence)).alias("level"),
        F.coalesce(-F.unix_seconds(seen.cast("timestamp")), F.lit(2**62)).alias("age"),
        F.col(row).cast("long").alias("row"),
    )
    rows = records.where(F.trim(F.col(group).cast("string")) != "").select(
        F.col(group).alias("group"),
        F.struct(*rank).alias("rank"),
        usable_phone(F.col(phone)).alias("phone"),
        usable_email(F.col(email)).alias("email"),
        level_of(F.col(confidence)).alias("level"),
        seen.alias("seen"),
    )

    def first(name: str) -> Column:
        return F.min(F.when(F.col(name).isNotNull(), F.struct("rank", F.col(name).alias("value")))).alias(name)

    best = rows.groupBy("group").agg(
        F.count("*").alias("n"), first("phone"), first("email"), F.min("level").alias("level"), F.max("seen").alias("seen")
    )
    return best.where("n >= 2").select(
        F.col("group").alias(group),
        F.coalesce("phone.value", F.lit("")).alias("phone"),
        F.coalesce("email.value", F.lit("")).alias("email"),
        F.coalesce(F.try_element_at(F.array(*[F.lit(x) for x in LEVELS]), F.when(F.col("level") <= 3, F.col("level"))), F.lit("")).alias("confidence"),
        F.coalesce(iso_text(F.col("seen")), F.lit("")).alias("last_seen"),
    )


def claims(records: DataFrame, group: str = "mirror_key", source: str = "source") -> DataFrame:
    """What each source states: distinct ``group, field, value, source`` over usable values."""
    base = records.where(F.trim(F.col(group).cast("string")) != "").select(
        F.col(group).alias("group"),
        F.coalesce(F.nullif(F.trim(source), F.lit("")), F.lit("?")).alias("source"),
        F.explode(
            F.array(
                F.struct(F.lit("phone").alias("field"), usable_phone(F.col("phone")).alias("value")),
                F.struct(F.lit("email").alias("field"), usable_email(F.col("email")).alias("value")),
            )
        ).alias("claim"),
    )
    return base.select("group", "source", "claim.*").where("value IS NOT NULL").distinct()


def _posterior(stated: list[str], silent: list[str], quality: dict[str, tuple[float, float]], prior: float) -> float:
    """Probability that a value is true, given who states it and who covers its group without stating it."""
    true, false = np.log(prior), np.log(1 - prior)
    for s in stated:
        sensitivity, specificity = quality[s]
        true += np.log(sensitivity)
        false += np.log(1 - specificity)
    for s in silent:
        sensitivity, specificity = quality[s]
        true += np.log(1 - sensitivity)
        false += np.log(specificity)
    return float(1 / (1 + np.exp(np.clip(false - true, -500, 500))))


def _trusted(right: float, of: float) -> float:
    """Share of ``right`` among ``of`` with the trust put in beforehand."""
    weight = 5 + TRUST_SHARE * of
    return (right + TRUST * weight) / (of + weight)


def judged_values(
    records: DataFrame, group: str = "mirror_key", source: str = "source", rounds: int = 20, least: float = 0.5
) -> tuple[DataFrame, DataFrame]:
    """Every stated value with its probability, and every source's quality.

    ``<group>, field, value, probability, kept`` and ``source, sensitivity,
    specificity``, both among values that any source states. A field may keep several values or none. Groups with one source
    go by that source's quality. Empty tables give empty results.

    Values of like patterns (who states, who covers without stating) are counted
    first; expectation-maximisation runs over patterns, the data is read twice only.
    It starts from, and leans to, sources that are mostly right: where the data say
    little about a source, true and false cannot change places.
    """
    stated = cut(claims(records, group, source))
    covering = stated.groupBy("group", "field").agg(F.array_sort(F.collect_set("source")).alias("covering"))
    # A group has at most as many covering sources as there are sources.
    values = (
        stated.groupBy("group", "field", "value")
        .agg(F.array_sort(F.collect_set("source")).alias("stated"))
        .join(big(covering), ["group", "field"])
        .select("group", "field", "value", "stated", F.array_except("covering", "stated").alias("silent"))
    )
    patterns = cut(values.groupBy("stated", "silent").agg(F.count("*").alias("n")))
    names = [r.source for r in stated.select("source").distinct().limit(MAX_SOURCES + 1).collect()]
    if len(names) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    quality = {s: (0.8, 0.8) for s in names}
    prior = 0.5
    for _ in range(rounds):
        now, now_prior = dict(quality), prior

        def expect(batches, now=now, now_prior=now_prior):
            for pdf in batches:
                rows = []
                for told, silent, n in zip(pdf["stated"], pdf["silent"], pdf["n"]):
                    p = _posterior(list(told), list(silent), now, now_prior)
                    rows += [(s, n * p, n * p, n * (1 - p), 0.0) for s in told]
                    rows += [(s, 0.0, n * p, n * (1 - p), n * (1 - p)) for s in silent]
                    rows.append(("", n * p, float(n), 0.0, 0.0))
                yield pd.DataFrame(rows, columns=["source", "hit", "true", "false", "kept_out"])

        totals = (
            patterns.mapInPandas(expect, "source string, hit double, true double, false double, kept_out double")
            .groupBy("source")
            .agg(*[F.sum(c).alias(c) for c in ("hit", "true", "false", "kept_out")])
            .collect()
        )
        if not totals:
            break
        fresh = {r.source: (_trusted(r.hit, r.true), _trusted(r.kept_out, r.false)) for r in totals if r.source}
        whole = next(r for r in totals if r.source == "")
        prior = float(np.clip(whole.hit / whole.true, 0.05, 0.95))
        moved = max((abs(a - b) for s in fresh for a, b in zip(fresh[s], quality[s])), default=0.0)
        quality = fresh
        if moved < 1e-4:
            break
    final, final_prior = dict(quality), prior

    def judge(batches):
        for pdf in batches:
            p = [_posterior(list(a), list(b), final, final_prior) for a, b in zip(pdf["stated"], pdf["silent"])]
            yield pdf[["group", "field", "value"]].assign(probability=p)

    kind = records.schema[group].dataType.simpleString()
    judged = values.mapInPandas(judge, f"group {kind}, field string, value string, probability double").select(
        F.col("group").alias(group), "field", "value", "probability", (F.col("probability") >= least).alias("kept")
    )
    qualities = records.sparkSession.createDataFrame(
        [(s, float(a), float(b)) for s, (a, b) in sorted(quality.items())], "source string, sensitivity double, specificity double"
    )
    return judged, qualities
