"""Variant spellings of names typed by people.

A prefix-filtered set-similarity join on the q-grams of a name's telling words. The
grams of its rare word (of its common one if it has no other), and of both words as
one for names parted otherwise, are put in order of their rarity over all names; the
prefix that two words of the wanted likeness must share is joined within the agency.
Names whose agency says nothing join by their prefixes alone. Hits are verified by a
soft weighted similarity of words in which the rare word counts most, and by the
parts that make properties of their own (phase, senior, family, kind of building).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.grams import keys_of, piece_counts, prefixes
from rollbook.llm.graph import components
from rollbook.llm.parse import Address
from rollbook.llm.pieces import (
    address_pieces,
    agency_keys,
    bodies_agree,
    givens_agree,
    name_pieces,
    place_score,
    said,
    words_agree,
)
from rollbook.session import big, cut, spaced

LEAST_SCORE = 0.8
#: Letters in a gram of a name.
GRAM = 4
FIELDS = ("rare", "common", "given", "mark", "ntype", "part", "phase", "body")


def distinct_names(rows: DataFrame, refs: DataFrame) -> DataFrame:
    """``name, agency, rep`` and pieces of each distinct pair of texts; texts of equal pieces share ``rep``."""
    texts = rows.select("name", "agency").distinct()
    return (
        texts.join(big(name_pieces(texts)), "name")
        .join(big(agency_keys(texts, refs)), "agency")
        .withColumn("key", F.when(F.col("rare") != "", F.col("rare")).otherwise(F.col("common")))
        .withColumn("rep", F.xxhash64(*FIELDS))
    )


def name_score(x: dict, y: dict) -> float:
    """0 where two names are different properties, else the similarity of their words.

    A phase tells properties apart, also against none. Kind and part do where both
    sides have one; a side with neither kind nor part leaves them open.
    """
    if x["phase"] != y["phase"] or not givens_agree(x["given"], y["given"]):
        return 0.0
    open_x, open_y = not (x["ntype"] or x["part"]), not (y["ntype"] or y["part"])
    if not (open_x or open_y):
        if x["part"] != y["part"] or (x["ntype"] and y["ntype"] and x["ntype"] != y["ntype"]):
            return 0.0
    if x["mark"] and y["mark"] and x["mark"] != y["mark"]:
        return 0.0
    return words_agree(x["rare"], x["common"], y["rare"], y["common"])


def gram_rows(reps: DataFrame) -> DataFrame:
    """A row for each prefix gram of each name: ``k, block, rep, word, phase``; of ``reps`` only ``rep, rare, common, phase, body`` count.

    ``k`` is the gram and which of the name's words it is from; ``word`` is that word.
    """
    base = spaced(reps.select("rep", "rare", "common", "phase", "body"))

    def words_in(pdf: pd.DataFrame) -> list[str]:
        """The telling word of each name, then both words as one."""
        return [r or c for r, c in zip(pdf["rare"], pdf["common"])] + list(pdf["rare"] + pdf["common"])

    counts = base.sparkSession.sparkContext.broadcast(piece_counts(base, words_in, GRAM))  # bounded, see piece_counts

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            words = words_in(pdf)
            owner, found = prefixes(words, GRAM, counts.value)
            row = owner % len(pdf)
            # Bodies outside the reference list may be misspelt themselves: one block.
            block = pdf["body"].where(~pdf["body"].str.startswith("~"), "~")
            yield pd.DataFrame(
                {
                    "k": keys_of(owner // len(pdf), found),
                    "block": block.to_numpy()[row],
                    "rep": pdf["rep"].to_numpy()[row],
                    "word": np.array(words, object)[owner],
                    "phase": pdf["phase"].to_numpy()[row],
                }
            )

    return base.mapInPandas(spread, "k long, block string, rep long, word string, phase string")


def name_links(reps: DataFrame) -> DataFrame:
    """Links between names that may be one property: ``a, b, fa, fb`` (reps and their fields), a < b."""
    facts = reps.select("rep", F.struct(*FIELDS).alias("f")).dropDuplicates(["rep"])
    rows = cut(gram_rows(facts.select("rep", "f.*")))
    x, y = (rows.select("k", "block", *[F.col(c).alias(f"{c}_{s}") for c in ("rep", "word", "phase")]) for s in "xy")
    silent = x.where("block = ''").drop("block")
    met = (
        x.where("block != ''").join(big(y.where("block != ''")), ["k", "block"]).where("rep_x < rep_y").drop("block")
    ).unionByName(
        # A name without agency meets all; two such names meet once.
        silent.join(big(y), "k").where("block != '' OR rep_x < rep_y").drop("block")
    )
    # Two slips are four changes of single letters at most.
    near = met.where("phase_x = phase_y").where(F.levenshtein("word_x", "word_y", 4) >= 0)
    pairs = near.select(F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b")).distinct()
    candidates = (
        pairs.join(big(facts.select(F.col("rep").alias("a"), F.col("f").alias("fa"))), "a")
        .join(big(facts.select(F.col("rep").alias("b"), F.col("f").alias("fb"))), "b")
        .select("a", "b", "fa", "fb")
    )

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = [
                bodies_agree(x["body"], y["body"]) is not False and name_score(x, y) >= LEAST_SCORE
                for x, y in zip(pdf["fa"], pdf["fb"])
            ]
            yield pdf[keep][["a", "b", "fa", "fb"]]

    kind = facts.schema["f"].dataType.simpleString()
    return candidates.mapInPandas(verify, f"a long, b long, fa {kind}, fb {kind}")


def _open(fields: str):
    """Whether a name leaves body or kind open."""
    f = F.col(fields)
    return (f["body"] == "") | ((f["ntype"] == "") & (f["part"] == ""))


def _sign(fields: str):
    """What tells a name's property from others of like words."""
    f = F.col(fields)
    return F.struct(f["body"].alias("body"), f["ntype"].alias("ntype"), f["part"].alias("part"))


def same_property(
    records: DataFrame,
    refs: DataFrame,
    key: str = "record_id",
    name: str = "property_name",
    agency: str = "authority",
    address: str = "address",
) -> DataFrame:
    """Pairs of records that name one property of one agency in different texts: ``<key>_a, <key>_b``, a < b.

    Names are compared once for each distinct pair of texts. A name that leaves its
    agency or kind of building open belongs to the property that its words fit; if
    they fit several, the record's own address decides, and if that does not, the
    record has no pair with any of them. NULL equals empty; nameless records never
    pair; equal texts are no pair; repeated rows each count.
    """
    rows = records.select(
        F.col(key).cast("long").alias("id"),
        said(name).alias("name"),
        said(agency).alias("agency"),
        said(address).alias("address"),
    ).where(F.trim("name") != "")
    texts = cut(distinct_names(rows, refs).where("key != ''"))
    reps = texts.select("rep", F.struct(*FIELDS).alias("f")).dropDuplicates(["rep"])
    links = cut(name_links(texts))
    members = cut(
        rows.join(big(texts.select("rep", "name", "agency")), ["name", "agency"]).select(
            "id", "rep", "address", F.xxhash64("name", "agency").alias("text")
        )
    )
    both = links.select("a", "b", "fa", "fb").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("fb").alias("fa"), F.col("fa").alias("fb"))
    )
    # What an open name could be: the signs of the closed names it is linked to.
    options = both.where(_open("fa") & ~_open("fb")).select("a", "b", _sign("fb").alias("sign"))
    ends = options.groupBy("a").agg(F.min("sign").alias("low"), F.max("sign").alias("high"))
    state = cut(
        reps.join(big(ends), reps["rep"] == ends["a"], "left").select(
            "rep",
            F.coalesce(F.col("low") != F.col("high"), F.lit(False)).alias("torn"),
            F.when(_open("f"), F.when(F.col("low") == F.col("high"), F.col("low"))).otherwise(_sign("f")).alias("sign"),
        )
    )
    # Torn names go by record: the sign whose records lie at the record's own place.
    torn = state.where("torn").select(F.col("rep").alias("a"))
    placed = _by_address(options.join(big(torn), "a", "left_semi"), members)
    settled = (
        members.join(big(state), "rep")
        .join(big(placed.select("id", "rep", F.col("sign").alias("chosen"))), ["id", "rep"], "left")
        .select("id", "rep", "text", "torn", F.coalesce("sign", "chosen").alias("sign"))
    )
    fields = ("id", "torn", "sign")
    a, b = (settled.select(F.col("rep").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in fields]) for s in "ab")
    across = links.select("a", "b").join(big(a), "a").join(big(b), "b")
    # Texts of equal pieces: records of one text are no pair and never meet.
    several = texts.select("rep", F.xxhash64("name", "agency").alias("text"))
    twins = several.select("rep", F.col("text").alias("a")).join(big(several.select("rep", F.col("text").alias("b"))), "rep").where("a < b")
    a, b = (settled.select(F.col("text").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in fields]) for s in "ab")
    inside = twins.select("a", "b").join(big(a), "a").join(big(b), "b")
    final = across.unionByName(inside)
    x, y = F.col("sign_a"), F.col("sign_b")
    # Both told: signs must fit. One untold and not torn: nothing speaks against it.
    fits = F.when(
        x.isNotNull() & y.isNotNull(),
        ((x["body"] == y["body"]) | x["body"].startswith("~") & y["body"].startswith("~"))
        & (x["part"] == y["part"])
        & ((x["ntype"] == y["ntype"]) | (x["ntype"] == "") | (y["ntype"] == "")),
    ).otherwise(~(F.col("torn_a") & x.isNull()) & ~(F.col("torn_b") & y.isNull()))
    return final.where(fits).select(
        F.least("id_a", "id_b").alias(f"{key}_a"), F.greatest("id_a", "id_b").alias(f"{key}_b")
    )


def _by_address(options: DataFrame, members: DataFrame) -> DataFrame:
    """For records of torn names the one sign with records at the same place: ``id, rep, sign``."""
    named = options.select(F.col("a").alias("rep")).unionByName(options.select(F.col("b").alias("rep"))).distinct()
    members = cut(members.where("address != ''").join(big(named), "rep", "left_semi"))
    pieces = cut(address_pieces(members))
    parts = ("number", "direction", "mark", "street", "stype", "city", "zip")
    where = pieces.where("number != ''").select("address", F.struct(*parts).alias("parts"))
    own = members.join(big(options.select(F.col("a").alias("rep")).distinct()), "rep", "left_semi").join(big(where), "address")
    other = (
        options.join(big(members.select(F.col("rep").alias("b"), F.col("address")).distinct()), "b")
        .join(big(where), "address")
        .select("a", "sign", F.col("parts").alias("other"))
        .distinct()
    )
    candidates = own.select("id", "rep", "parts").join(
        big(other), (own["rep"] == other["a"]) & (F.col("parts.number") == F.col("other.number"))
    ).select("id", "rep", "sign", "parts", "other")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = [
                bool(place_score(Address(*(x[c] for c in parts)), Address(*(y[c] for c in parts))))
                for x, y in zip(pdf["parts"], pdf["other"])
            ]
            yield pdf[keep][["id", "rep", "sign"]]

    at = candidates.mapInPandas(verify, f"id long, rep long, sign {options.schema['sign'].dataType.simpleString()}")
    return (
        at.distinct()
        .groupBy("id", "rep")
        .agg(F.count("*").alias("n"), F.first("sign").alias("sign"))
        .where("n = 1")
        .select("id", "rep", "sign")
    )


def name_classes(records: DataFrame, refs: DataFrame, key: str = "record_id", name: str = "property_name", agency: str = "authority") -> DataFrame:
    """A row for each named record: ``<key>, property, links``.

    ``property`` is the smallest key of the records joined to it by links between
    names that leave neither agency nor kind open; ``links`` counts the wordings that
    the record's own is linked to. Copies of one text share their class; pairs of records are never made.
    """
    rows = records.select(F.col(key).cast("long").alias("id"), said(name).alias("name"), said(agency).alias("agency")).where(F.trim("name") != "")
    texts = cut(distinct_names(rows, refs).where("key != ''"))
    links = cut(name_links(texts).where(~_open("fa") & ~_open("fb")).select("a", "b"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    several = texts.groupBy("rep").agg(F.count("*").alias("wordings"))
    linked = both.join(big(several.withColumnRenamed("rep", "b")), "b").groupBy(F.col("a").alias("rep")).agg(F.sum("wordings").alias("others"))
    state = (
        several.join(big(linked), "rep", "left")
        .join(big(components(links).withColumnRenamed("node", "rep")), "rep", "left")
        .select("rep", F.coalesce("component", "rep").alias("class"), (F.col("wordings") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    )
    told = cut(rows.join(big(texts.select("name", "agency", "rep")), ["name", "agency"]).join(big(state), "rep").select("id", "class", "links"))
    first = told.groupBy("class").agg(F.min("id").alias("property"))
    return told.join(big(first), "class").select(F.col("id").alias(key), "property", "links")
