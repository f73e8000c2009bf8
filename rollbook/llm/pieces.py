"""Distinct typed texts with their parsed pieces, and the corpus statistics they need."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.canonical import map_agencies
from rollbook.llm.grams import slips_in
from rollbook.llm.parse import Address, SlipIndex, alike, distance, parse_address, parse_agency, parse_name
from rollbook.session import big, cut, spaced

#: A word is common from this share of all pairs of words on, whatever the number of names; twice as many words at most can be.
COMMON_SHARE = 1 / 1000

ADDRESS_SCHEMA = "address string, number string, direction string, mark string, street string, stype string, city string, zip string"
NAME_SCHEMA = "name string, words array<string>, given string, mark string, ntype string, part string, phase string"


def said(column: str) -> Column:
    """Text of a column, missing as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def address_pieces(addresses: DataFrame) -> DataFrame:
    """Pieces of the distinct texts in column ``address``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame(
                [(t, *parse_address(t)) for t in pdf["address"]],
                columns=["address", "number", "direction", "mark", "street", "stype", "city", "zip"],
            )

    return spaced(addresses.select("address").distinct()).mapInPandas(run, ADDRESS_SCHEMA)


def zip_cities(pieces: DataFrame) -> DataFrame:
    """The city most often written with each zip code: at most 100,000 rows, by the form of a zip code."""
    counted = pieces.where("zip != '' AND city != ''").groupBy("zip", "city").count()
    return counted.groupBy("zip").agg(F.max(F.struct("count", "city")).alias("top")).select(
        "zip", F.col("top.city").alias("zip_city")
    )


def common_words(pieces: DataFrame) -> dict[str, int]:
    """Words met beside many different words, with that number.

    Counted over all names. A word needs a share of ``COMMON_SHARE`` of all pairs
    of words and more than one partner, so at most ``1 / COMMON_SHARE`` words
    qualify and come to the driver.
    """
    two = pieces.where(F.size("words") == 2).select(F.sort_array("words").alias("w"), "words").distinct()
    pairs = two.select(F.col("words")[0].alias("a"), F.col("words")[1].alias("b")).distinct()
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    total = both.count()
    found = (
        both.groupBy("a").count().where(F.col("count") >= max(2, total * COMMON_SHARE)).collect()
    )
    return {r["a"]: r["count"] for r in found}


def _common_of(word: str, index: SlipIndex) -> str:
    """The common word that ``word`` is, up to slips; empty if none."""
    if word in index.known:
        return word
    if len(word) < 4:
        return ""
    near = [(n, k) for n, k in index.near(word) if n <= (2 if min(len(k), len(word)) >= 6 else 1 if len(k) >= 4 else 0)]
    return near[0][1] if near else ""


def split_words(words: list[str], index: SlipIndex, cache: dict[str, str]) -> tuple[str, str, bool]:
    """The rare word of a name, its common word (either may be empty), and whether the common one is known."""

    def known(word: str) -> str:
        if word not in cache:
            cache[word] = _common_of(word, index)
        return cache[word]

    words, common = list(words), index.known
    if len(words) == 1 and words[0] not in common:
        # Glued to its common word.
        for tail in common:
            if len(tail) >= 5 and words[0].endswith(tail) and len(words[0]) - len(tail) >= 5:
                return words[0][: -len(tail)], tail, True
    exact = [w for w in words if w in common]
    if len(exact) < len(words) and exact:
        rest = [w for w in words if w not in common]
        return "".join(rest), exact[-1], True
    if exact:
        return ("", exact[0], True) if len(words) == 1 else (exact[0], exact[-1], True)
    if len(words) == 1:
        near = known(words[0])
        return ("", near, True) if near else (words[0], "", False)
    # The later word is the common one where both could be.
    for k in range(len(words) - 1, -1, -1):
        if near := known(words[k]):
            return "".join(words[:k] + words[k + 1 :]), near, True
    # None is known: the last word is the most likely one.
    return "".join(words[:-1]), words[-1] if words else "", False


def name_pieces(names: DataFrame) -> DataFrame:
    """Pieces of the distinct texts in column ``name``, with ``rare`` and ``common``, the two words that tell it apart, and ``topic``, the common one if it is known."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(t, *parse_name(t)) for t in pdf["name"]]
            yield pd.DataFrame(
                [(r[0], list(r[1]), *r[2:]) for r in rows],
                columns=["name", "words", "given", "mark", "ntype", "part", "phase"],
            )

    parsed = cut(spaced(names.select("name").distinct()).mapInPandas(run, NAME_SCHEMA))
    common = common_words(parsed)
    shared = names.sparkSession.sparkContext.broadcast(common)  # bounded, see common_words

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, str] = {}
        index = SlipIndex(dict.fromkeys(shared.value, ""), 2)
        for pdf in batches:
            two = [split_words(w, index, cache) for w in pdf["words"]]
            yield pdf.assign(rare=[t[0] for t in two], common=[t[1] for t in two], topic=[t[1] if t[2] else "" for t in two])

    return parsed.mapInPandas(tell, NAME_SCHEMA + ", rare string, common string, topic string")


def agency_keys(agencies: DataFrame, refs: DataFrame) -> DataFrame:
    """``agency, body``: the reference entry where one is meant, else kind and words, ``''`` if it says nothing."""
    texts = spaced(agencies.select("agency").distinct())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(t, parse_agency(t)) for t in pdf["agency"]]
            yield pd.DataFrame(
                [(t, f"~{a.kind}:{' '.join(a.core)}" if a.core else "") for t, a in rows], columns=["agency", "typed"]
            )

    typed = texts.mapInPandas(run, "agency string, typed string")
    known = map_agencies(texts.where("agency != ''").select(F.col("agency").alias("text")), refs)
    return typed.join(known.select(F.col("text").alias("agency"), "canonical"), "agency", "left").select(
        "agency", F.coalesce("canonical", "typed").alias("body")
    )


def bodies_agree(a: str, b: str) -> bool | None:
    """Whether two bodies are one; None if one says nothing."""
    if not a or not b:
        return None
    if a == b:
        return True
    if a[0] == "~" and b[0] == "~":
        kind_a, _, core_a = a[1:].partition(":")
        kind_b, _, core_b = b[1:].partition(":")
        return (kind_a == kind_b or not kind_a or not kind_b) and alike(core_a, core_b)
    return False


def words_alike(a: str, b: str) -> bool:
    """The same word up to the slips that its length bears; what holds a digit bears none."""
    if a == b:
        return True
    most = slips_in(min(len(a), len(b)))
    if not most or any(c.isdigit() for c in a + b):
        return False
    return distance(a, b, most) <= most


def cities_agree(a: Address, b: Address, city_a: str, city_b: str) -> bool | None:
    """Whether two addresses lie in one city; ``city_*`` is the city of the zip code. None if one does not say."""
    if a.zip and b.zip:
        return a.zip == b.zip
    one, other = city_a or a.city, city_b or b.city
    if not one or not other:
        return None
    return alike(one, other) or distance(one, other, 2) <= 2


def place_score(a: Address, b: Address, city_a: str = "", city_b: str = "") -> float | None:
    """0 where two addresses are different places, up to 1 where every part agrees; None if one has no street and number."""
    if not a.number or not b.number:
        return None
    if a.number != b.number or not words_alike(a.street, b.street):
        return 0.0
    score = 0.7
    for x, y in ((a.direction, b.direction), (a.type, b.type), (a.mark, b.mark)):
        if x and y and x != y:
            return 0.0
        score += 0.05 * (x == y)
    same = cities_agree(a, b, city_a, city_b)
    if same is False:
        return 0.0
    return score + (0.15 if same else 0.0)


def words_agree(rare_a: str, common_a: str, rare_b: str, common_b: str) -> float:
    """Soft similarity of two names' telling words, rare ones counting most; 0 where they differ, 0.5 where nothing can be said.

    A word missing on one side costs its weight but is no difference.
    """
    heavy, light = 0.75, 0.25
    got, total, edits = 0.0, 0.0, 0
    for x, y, weight in ((rare_a, rare_b, heavy), (common_a, common_b, light)):
        if not x or not y:
            total += weight / 2 if (x or y) else 0.0
            continue
        total += weight
        most = slips_in(min(len(x), len(y)))
        n = distance(x, y, most)
        if n > most:
            # Glued or parted otherwise: compare the whole.
            most = slips_in(min(len(rare_a + common_a), len(rare_b + common_b)))
            return 0.9 if distance(rare_a + common_a, rare_b + common_b, most) <= most else 0.0
        edits += n
        got += weight * (1 - n / max(len(x), len(y)))
    if edits > 3 or not total:
        return 0.0 if edits > 3 else 0.5
    return got / total


def givens_agree(a: str, b: str) -> bool:
    return not a or not b or bool(set(a.split("|")) & set(b.split("|")))
