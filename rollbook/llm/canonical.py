"""Free-typed values mapped to the entries of a reference list.

A prefix-filtered set-similarity join: every value and every alias of a reference
entry is a set of letter pairs (neighbours and next but one, so that a swap of two
letters costs little). Sets are ordered by how rare a pair is over all values;
only the rarest pairs - the prefix that two sets of the wanted similarity must
share - are joined; length and position of the hit rule out most of the rest, the
Jaccard similarity is then computed exactly, and the best entry is kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.parse import distance, parse_agency, plain
from rollbook.session import big

#: Letter pairs use 36 letters and digits and a word mark: at most 37 * 37 different ones.
MAX_PAIRS = 37 * 37
#: Cells of one text that go to one task at most, about, and in how many parts every text is cut at least.
SALT_ROWS, SALTS = 500_000, 8


def letter_pairs(words: Iterable[str]) -> set[str]:
    """Ordered pairs of letters one or two places apart, with marks at both ends of a word."""
    pairs = set()
    for word in words:
        padded = f"_{word}_"
        for k in range(len(padded) - 1):
            pairs.add(padded[k : k + 2])
            if k + 2 < len(padded):
                pairs.add(padded[k] + padded[k + 2])
    pairs.discard("__")
    return pairs


def _ascii_words(words: Iterable[str]) -> list[str]:
    return [w for w in ("".join(c for c in x.lower() if c.isascii() and c.isalnum()) for x in words) if w]


SET_SCHEMA = "text string, kind string, exact boolean, pairs array<string>"


def pair_sets(texts: DataFrame, describe: Callable[[str], list[tuple[str, list[str], bool]]], extra: str = "") -> DataFrame:
    """A row for each description (kind, words, only exact) of each ``text``; ``extra`` columns ride along."""
    carried = [c for c in texts.columns if c != "text"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for record in pdf.itertuples(index=False):
                for kind, words, exact in describe(record.text):
                    pairs = letter_pairs(_ascii_words(words))
                    if pairs:
                        rows.append((record.text, kind, exact, sorted(pairs), *[getattr(record, c) for c in carried]))
            yield pd.DataFrame(rows, columns=["text", "kind", "exact", "pairs", *carried])

    return texts.mapInPandas(run, SET_SCHEMA + extra)


def _rarity(sets: DataFrame) -> dict[str, int]:
    """Number of sets that hold each pair, over all of them; bounded by the alphabet."""
    found = sets.select(F.explode("pairs").alias("pair")).groupBy("pair").count().limit(MAX_PAIRS + 1).collect()
    if len(found) > MAX_PAIRS:
        raise ValueError("letter pairs outside the alphabet")
    return {r["pair"]: r["count"] for r in found}


def _with_prefix(sets: DataFrame, rarity: dict[str, int], threshold: float) -> DataFrame:
    """The set in order of rarity and a row for each pair of its prefix."""
    names = [c for c in sets.columns if c != "pairs"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ordered = [sorted(p, key=lambda x: (rarity.get(x, 0), x)) for p in pdf["pairs"]]
            yield pdf.assign(
                pairs=ordered,
                prefix=[o[: len(o) - math.ceil(threshold * len(o)) + 1] for o in ordered],
            )[[*names, "pairs", "prefix"]]

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sets.schema.fields if f.name != "pairs")
    return sets.mapInPandas(run, f"{schema}, pairs array<string>, prefix array<string>")


def best_entries(
    values: DataFrame,
    aliases: DataFrame,
    threshold: float,
    agree: Callable[[str, str], F.Column] | None = None,
) -> DataFrame:
    """The best entry of each value: ``text, canonical, similarity``.

    ``values`` and ``aliases`` are sets of :func:`pair_sets`, aliases with
    ``canonical`` and ``priority``. Values below ``threshold`` with every alias
    have no row. Ties go to the smaller priority, then the smaller canonical.
    """
    rarity = _rarity(values.select("pairs").unionByName(aliases.select("pairs")))
    left = _with_prefix(values, rarity, threshold).select(
        "text", "kind", "pairs", F.size("pairs").alias("n"), F.posexplode("prefix").alias("i", "pair")
    )
    right = _with_prefix(aliases, rarity, threshold).select(
        F.col("kind").alias("alias_kind"),
        "exact",
        "canonical",
        "priority",
        F.col("pairs").alias("alias_pairs"),
        F.size("pairs").alias("m"),
        F.posexplode("prefix").alias("j", "pair"),
    )
    least = F.ceil(F.lit(threshold / (1 + threshold)) * (F.col("n") + F.col("m")))
    hits = left.join(right, "pair").where(
        (F.col("n") >= threshold * F.col("m"))
        & (F.col("m") >= threshold * F.col("n"))
        & (1 + F.least(F.col("n") - F.col("i") - 1, F.col("m") - F.col("j") - 1) >= least - F.least("i", "j"))
    )
    if agree is not None:
        hits = hits.where(agree("kind", "alias_kind"))
    shared = F.size(F.array_intersect("pairs", "alias_pairs"))
    scored = hits.withColumn("similarity", shared / (F.col("n") + F.col("m") - shared)).where(
        (F.col("similarity") >= threshold) & (~F.col("exact") | (F.col("similarity") == 1.0))
    )
    best = scored.groupBy("text").agg(
        F.min(F.struct((-F.col("similarity")).alias("s"), "priority", "canonical")).alias("best")
    )
    return best.select("text", F.col("best.canonical").alias("canonical"), (-F.col("best.s")).alias("similarity"))


def describe_agency(text: str) -> list[tuple[str, list[str], bool]]:
    agency = parse_agency(text)
    return [(agency.kind, list(agency.core), False)] if agency.core else []


# What people write for a listing status.
STATUS_PHRASES = {
    "open": "open|open now|now open|open for applications|applications open|accepting applications|now accepting applications"
    "|accepting apps|taking applications|open apply now|apply now|now leasing|leasing now|leasing|now renting|for rent|available"
    "|avail|available now|units available|vacancy|vacancies|vacancy available|currently open|applications accepted|opened",
    "waitlist": "waitlist|wait list|waiting list|waitlisted|on waitlist|waitlist open|waitlist only|wait list only"
    "|waiting list only|waiting list available|waitlist available|join the waitlist|join waitlist|w l|wl|interest list"
    "|interest list only|waiting list open|wait list open|on the waiting list",
    "coming_soon": "coming soon|coming|opening soon|open soon|soon to open|opens soon|under construction|in construction|planned"
    "|in planning|pre leasing soon|pre leasing|future opening|future|coming 2025|coming 2026|coming 2027|coming 2028|opens spring"
    "|opens summer|opens fall|opens winter|opens 2026|opening 2026|opening spring|coming spring|coming summer|coming fall"
    "|not yet open|not yet available|proposed|in development|being built",
    "closed": "closed|close|closed check back|applications closed|application closed|not accepting applications|no longer accepting applications"
    "|full|fully leased|fully occupied|leased up|leased|filled|no vacancy|no vacancies|no units available|none available|not available"
    "|unavailable|lottery over|lottery closed|waitlist closed|waiting list closed|wait list closed|waitlist full|sold out|occupied"
    "|not open|no openings|rented|all units leased|deadline passed|not leasing",
}
# What people write where they do not say a status.
NO_STATUS = "not stated|see website|see flyer|see page|varies|unknown|call office|n a|contact property|ask manager|ask at front desk|refer to city|tbc w owner|tbd|call for info|ref|ext"


def describe_status(text: str) -> list[tuple[str, list[str], bool]]:
    """One set of the whole phrase without blanks; kind ``no`` where the first words deny."""
    words = re.findall(r"[a-z0-9]+", re.sub(r"\(.*?\)", " ", plain(text).lower()))
    squeezed = "".join(words)
    denies = not squeezed.startswith("now") and any(w in ("no", "none") or (w != "on" and distance(w, "not", 1) <= 1) for w in words[:2])
    return [("no" if denies else "", [squeezed], False)] if words else []


def _agency_aliases(refs: DataFrame) -> DataFrame:
    """Aliases of reference agencies: full label, and the short name where it is met exactly."""
    # City and town come first where a bare place name fits several bodies.
    priority = F.when(F.col("kind").isin("city", "town"), 0).otherwise(1)
    base = refs.where(F.col("authority").isNotNull()).select(
        "authority", "short_name", priority.cast("int").alias("priority")
    )
    full = base.select(F.col("authority").alias("text"), F.col("authority").alias("canonical"), "priority")
    code = base.where(F.trim("short_name") != "").select(
        F.col("short_name").alias("text"), F.col("authority").alias("canonical"), "priority"
    )
    extra = ", canonical string, priority int"
    return pair_sets(full, describe_agency, extra).unionByName(
        pair_sets(code, lambda t: [("", [plain(t).lower()], True)], extra)
    )


def _agency_kinds(kind: str, alias_kind: str) -> F.Column:
    """Kinds agree, or the value is a bare name, or a county without saying which body."""
    return (
        (F.col(kind) == F.col(alias_kind))
        | (F.col(kind) == "")
        | ((F.col(kind) == "county") & F.col(alias_kind).isin("authority", "office"))
    )


def map_agencies(texts: DataFrame, refs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``text, canonical, similarity`` of the distinct ``texts`` that a reference agency matches."""
    values = pair_sets(texts.select("text").where(F.col("text").isNotNull()).distinct(), describe_agency)
    return best_entries(values, _agency_aliases(refs), threshold, _agency_kinds)


def map_statuses(texts: DataFrame, refs: DataFrame, threshold: float = 0.45) -> DataFrame:
    """``text, canonical, similarity`` of the distinct ``texts`` that a reference status matches.

    Phrases that say no status take part, with an empty canonical.
    """
    spark = texts.sparkSession
    phrases = spark.createDataFrame(
        [(phrase, status) for status, group in STATUS_PHRASES.items() for phrase in group.split("|")],
        "text string, canonical string",
    )
    known = refs.where(F.col("listing_status").isNotNull()).select(F.col("listing_status").alias("canonical"))
    aliases = (
        phrases.join(known, "canonical", "left_semi")
        .select("text", "canonical")
        .unionByName(known.select(F.translate("canonical", "_", " ").alias("text"), "canonical"))
        .unionByName(spark.createDataFrame([(p, "") for p in NO_STATUS.split("|")], "text string, canonical string"))
        .distinct()
        .withColumn("priority", F.lit(0))
    )
    values = pair_sets(texts.select("text").where(F.col("text").isNotNull()).distinct(), describe_status)
    return best_entries(
        values,
        pair_sets(aliases, describe_status, ", canonical string, priority int"),
        threshold,
        lambda kind, alias_kind: F.col(kind) == F.col(alias_kind),
    )


def map_cells(
    records: DataFrame, key: str, field: str, refs: DataFrame, mapper: Callable[[DataFrame, DataFrame], DataFrame]
) -> DataFrame:
    """A row for each cell of ``field`` that is neither missing nor a reference entry as it stands.

    ``key, field, canonical``; canonical is ``''`` where no entry is meant. NULL and
    blank cells are missing. Similarity is computed once for each distinct text;
    the mapping goes back to the cells by a join salted over the cells, since one
    text may be in a third of them; there are as many salts as the number of records asks for.
    """
    salts = max(SALTS, -(-records.count() // SALT_ROWS))
    known = refs.select(F.col(field).alias("cell")).where(F.col("cell").isNotNull()).distinct()
    cells = (
        records.select(F.col(key).alias(key), F.col(field).alias("cell"))
        .where(F.trim("cell") != "")
        .join(known, "cell", "left_anti")
    )
    mapping = mapper(cells.select(F.col("cell").alias("text")).distinct(), refs).select(
        F.col("text").alias("cell"), "canonical", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    )
    salted = cells.withColumn("salt", F.pmod(F.xxhash64(F.col(key)), F.lit(salts)).cast("int"))
    return salted.join(big(mapping), ["cell", "salt"], "left").select(
        F.col(key), F.lit(field).alias("field"), F.coalesce("canonical", F.lit("")).alias("canonical")
    )
