"""Postal addresses that denote the same place.

A set-containment join for missing parts. An address is the set of its tokens: the
letter pairs of its street name, each bound to the house number, and its direction,
type, mark and city, each with a weight. The address with fewer parts is indexed by
its rarest tokens - as many as one of which a fuller wording of the same street must
hold despite slips -, fuller addresses probe with theirs. A hit must hold enough of
the indexed set by weight and contradict none of its parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.grams import keys_of, piece_counts, prefixes
from rollbook.llm.graph import components
from rollbook.llm.parse import Address, distance, parse_name
from rollbook.llm.pieces import address_pieces, place_score, said, words_alike, zip_cities
from rollbook.session import big, cut, spaced

PARTS = ("number", "direction", "mark", "street", "stype", "city", "zip")
#: Letters in a token of a street name.
GRAM = 2
#: Weights of an address's parts: what tells more places apart counts more.
WEIGHTS = {"number": 3.0, "street": 5.0, "direction": 1.0, "mark": 1.0, "stype": 1.0, "city": 2.0}
#: Share of the sparser address's weight that the fuller one holds at least.
CONTAINED = 0.6


def contained(x: Address, y: Address, city_x: str = "", city_y: str = "") -> float:
    """Weighted share of address ``x`` that ``y`` holds, 0 where a part of one contradicts the other.

    A street name with slips is held by the share of letters that agree; a part that
    only ``x`` names is not held.
    """
    if not place_score(x, y, city_x, city_y):
        return 0.0
    held = WEIGHTS["number"] + WEIGHTS["street"] * (1 - distance(x.street, y.street, 2) / max(len(x.street), len(y.street)))
    whole = WEIGHTS["number"] + WEIGHTS["street"]
    for name, mine, other in (
        ("direction", x.direction, y.direction), ("mark", x.mark, y.mark), ("stype", x.type, y.type), ("city", x.city or x.zip, y.city or y.zip)
    ):
        if mine:
            whole += WEIGHTS[name]
            held += WEIGHTS[name] * bool(other)
    return held / whole


def _said_parts(x: Address) -> int:
    return sum(bool(p) for p in (x.direction, x.mark, x.type, x.city or x.zip))


def same_location(x: Address, y: Address, city_x: str = "", city_y: str = "") -> bool:
    """Whether the fuller of two addresses holds enough of the other; of equally full ones either may be."""
    n, m = _said_parts(x), _said_parts(y)
    return (n <= m and contained(x, y, city_x, city_y) >= CONTAINED) or (m <= n and contained(y, x, city_y, city_x) >= CONTAINED)


def token_rows(places: DataFrame) -> DataFrame:
    """A row for each of the rarest tokens of each place: ``k`` and the columns of ``places``, which hold ``number`` and ``street``."""

    def streets(pdf: pd.DataFrame) -> list[str]:
        return list(pdf["street"])

    counts = places.sparkSession.sparkContext.broadcast(piece_counts(places, streets, GRAM))  # bounded, see piece_counts

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            owner, found = prefixes(streets(pdf), GRAM, counts.value)
            yield pdf.iloc[owner].assign(k=keys_of(pdf["number"].to_numpy(np.int64)[owner], found))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in places.schema.fields)
    return places.mapInPandas(spread, f"{schema}, k long")


def wording_links(places: DataFrame) -> DataFrame:
    """Links between different wordings of one place: ``a, b, pa, pb`` (their ``place`` and parts), each pair once.

    ``places`` has a row for each ``place`` with its parts and ``zip_city``; those
    without street and number have no links.
    """
    # Fuller addresses name more parts.
    fullness = sum(((F.col(c) != "").cast("int") for c in ("direction", "stype", "mark")), F.lit(0)) + (
        (F.col("city") != "") | (F.col("zip") != "")
    ).cast("int")
    rows = cut(token_rows(spaced(places.where("number != '' AND street != ''").withColumn("n", fullness))))
    fields = F.struct(*PARTS, "zip_city")
    index = rows.select("k", F.col("place").alias("a"), F.col("n").alias("na"), fields.alias("pa"))
    probe = rows.select("k", F.col("place").alias("b"), F.col("n").alias("nb"), fields.alias("pb"))

    def clash(part: str):
        x, y = F.col(f"pa.{part}"), F.col(f"pb.{part}")
        return (x != "") & (y != "") & (x != y)

    hits = (
        index.join(big(probe), "k")
        .where((F.col("nb") > F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("a") < F.col("b"))))
        .where(~clash("direction") & ~clash("stype") & ~clash("mark") & ~clash("zip") & (F.col("pa.number") == F.col("pb.number")))
        # Two slips are four changes of single letters at most.
        .where(F.levenshtein(F.col("pa.street"), F.col("pb.street"), 4) >= 0)
        .groupBy("a", "b")
        .agg(F.first("pa").alias("pa"), F.first("pb").alias("pb"))
    )

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = [
                same_location(*(Address(*(z[c] for c in PARTS)) for z in (x, y)), x["zip_city"], y["zip_city"])
                for x, y in zip(pdf["pa"], pdf["pb"])
            ]
            yield pdf[keep][["a", "b", "pa", "pb"]]

    schema = f"a long, b long, pa {index.schema['pa'].dataType.simpleString()}, pb {probe.schema['pb'].dataType.simpleString()}"
    return hits.mapInPandas(verify, schema)


def _with_doubt(links: DataFrame) -> DataFrame:
    """``a, b, doubtful``: a doubtful link has a place that lacks a part in which its partners differ."""
    both = links.select("a", "pa", "pb").unionByName(links.select(F.col("b").alias("a"), F.col("pb").alias("pa"), F.col("pa").alias("pb")))

    def torn(part: str):
        # Of a part with more than one value only two are looked at: smallest and largest.
        lacking = F.when((F.col(f"pa.{part}") == "") & (F.col(f"pb.{part}") != ""), F.col(f"pb.{part}"))
        return F.coalesce(F.min(lacking) != F.max(lacking), F.lit(False))

    doubt = (
        both.groupBy("a")
        .agg((torn("direction") | torn("stype") | torn("mark")).alias("torn"))
        .where("torn")
        .select(F.col("a").alias("text"))
    )
    marked = links.select("a", "b")
    for side in ("a", "b"):
        marked = marked.join(big(doubt.select(F.col("text").alias(side), F.lit(True).alias(f"torn_{side}"))), side, "left")
    return marked.select("a", "b", F.coalesce("torn_a", "torn_b", F.lit(False)).alias("doubtful"))


def names_fit(a: str, b: str) -> bool:
    """Whether two property names share most of the letters of their telling words."""
    x, y = parse_name(a).words, parse_name(b).words
    if not x or not y:
        return False
    left = list(y)
    shared = 0
    for word in x:
        if found := next((w for w in left if words_alike(word, w)), None):
            left.remove(found)
            shared += len(word) + len(found)
    whole = sum(map(len, x)) + sum(map(len, y))
    return shared >= 0.7 * whole or words_alike("".join(x), "".join(y))


def located(records: DataFrame, key: str, address: str, name: str, keep: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Records with a street address (``id, text, name, place``, and the address itself if kept) and the distinct places with their parts."""
    rows = records.select(F.col(key).cast("long").alias("id"), said(address).alias("address"), said(name).alias("name")).where("address != ''")
    pieces = cut(address_pieces(rows))
    cities = F.broadcast(zip_cities(pieces))  # a row for each five-digit code at most
    full = pieces.where("number != '' AND street != ''").join(cities, "zip", "left").withColumn("zip_city", F.coalesce("zip_city", F.lit("")))
    texts = full.select("address", *PARTS, "zip_city", F.xxhash64(*PARTS).alias("place"))
    members = cut(rows.join(big(texts.select("address", "place")), "address").select("id", F.xxhash64("address").alias("text"), "name", "place", *([keep] if keep else [])))
    return members, texts.drop("address").dropDuplicates(["place"])


def place_links(addresses: DataFrame) -> DataFrame:
    """``a, b``: pairs of different texts of column ``address`` that denote one place, names aside."""
    texts, places = located(addresses.select(F.lit(0).alias("id"), "address", F.lit("").alias("name")).distinct(), "id", "address", "name", keep="address")
    a, b = (texts.select(F.col("address").alias(s), F.col("place").alias(f"p{s}")) for s in "ab")
    links = wording_links(places).select(F.col("a").alias("pa"), F.col("b").alias("pb"))
    return links.join(big(a), "pa").join(big(b), "pb").select("a", "b").unionByName(a.join(big(b), F.col("pa") == F.col("pb")).where("a < b").select("a", "b"))


def same_place(records: DataFrame, key: str = "record_id", address: str = "address", name: str = "property_name") -> DataFrame:
    """Pairs of records whose addresses differ as text and denote the same place: ``<key>_a, <key>_b``, a < b.

    Addresses are compared once for each distinct wording; records follow by hash.
    Where a text lacks the part that tells two places apart, the pair also needs
    names that agree. NULL, blank and street-less addresses never pair; equal
    texts are no pair; ties and repeated rows each count.
    """
    members, places = located(records, key, address, name)
    links = _with_doubt(cut(wording_links(places)))
    left = members.select(F.col("id").alias("ia"), F.col("text").alias("ta"), F.col("place").alias("a"), F.col("name").alias("na"))
    right = members.select(F.col("id").alias("ib"), F.col("text").alias("tb"), F.col("place").alias("b"), F.col("name").alias("nb"))
    met = links.join(big(left), "a").join(big(right), "b")
    sure = met.where("NOT doubtful").select("ia", "ib")

    def fitting(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[[names_fit(x, y) for x, y in zip(pdf["na"], pdf["nb"])]][["ia", "ib"]]

    fit = met.where("doubtful").select("ia", "ib", "na", "nb").mapInPandas(fitting, "ia long, ib long")
    # Texts of equal parts: records of one text are no pair and never meet.
    texts = members.select("place", "text").distinct()
    twins = texts.select("place", F.col("text").alias("ta")).join(big(texts.select("place", F.col("text").alias("tb"))), "place").where("ta < tb")
    inside = twins.select("ta", "tb").join(big(left.select("ta", "ia")), "ta").join(big(right.select("tb", "ib")), "tb").select("ia", "ib")
    return sure.unionByName(fit).unionByName(inside).select(
        F.least("ia", "ib").alias(f"{key}_a"), F.greatest("ia", "ib").alias(f"{key}_b")
    )


def place_classes(records: DataFrame, key: str = "record_id", address: str = "address", name: str = "property_name") -> DataFrame:
    """A row for each record with a street address: ``<key>, place, links``.

    ``place`` is the smallest key of the records joined to it by links that no missing
    part makes doubtful; ``links`` counts the records that it is linked to itself.
    Copies of one text share their class and are no links; pairs are never made.
    """
    members, places = located(records, key, address, name)
    marked = cut(_with_doubt(cut(wording_links(places))))
    sure = marked.where("NOT doubtful").select("a", "b")
    classes = components(sure)
    sizes = members.groupBy("place").agg(F.count("*").alias("n"))
    texts = members.groupBy("place", "text").agg(F.count("*").alias("own"))
    both = sure.unionByName(sure.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(big(sizes.withColumnRenamed("place", "b")), "b").groupBy(F.col("a").alias("place")).agg(F.sum("n").alias("others"))
    told = (
        members.join(big(texts), ["place", "text"])
        .join(big(sizes), "place")
        .join(big(linked), "place", "left")
        .join(big(classes.select(F.col("node").alias("place"), "component")), "place", "left")
        .select("id", F.coalesce("component", "place").alias("class"), (F.col("n") - F.col("own") + F.coalesce("others", F.lit(0))).alias("links"))
    )
    told = cut(told)
    first = told.groupBy("class").agg(F.min("id").alias("place"))
    return told.join(big(first), "class").select(F.col("id").alias(key), "place", "links")
