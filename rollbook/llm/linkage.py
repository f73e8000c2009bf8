"""Entities of two sources matched without a common key.

Sorted neighbourhood over several composite sort keys: an address key (house number
and a rare letter pair of the street, then street and name) and two name keys (a rare
gram of the telling word, or of both words as one, then the name) for records without
a number. Distinct parsed records of both sides are put in these orders, and a window
slides over each; it is as long as the leading part of the key stays the same, so
that, by the prefix principle of ``grams``, every pair the score can accept stands in
one window. What the window lets through is scored by weighted similarities of name,
address and agency.

Scored records form components. In each the records of one side that do not
contradict each other are one property, and the one-to-one assignment of properties
with the highest total confidence decides what is kept: repeated and redelivered
records of one property each keep their match. A record that leaves open which of
several properties of its own side it is keeps its most confident matches, within
``SLACK`` of the best.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.grams import keys_of, piece_counts, prefixes
from rollbook.llm.graph import best_assignment, components
from rollbook.llm.parse import Address
from rollbook.llm.pieces import (
    address_pieces,
    agency_keys,
    bodies_agree,
    cities_agree,
    givens_agree,
    name_pieces,
    said,
    words_agree,
    words_alike,
    zip_cities,
)
from rollbook.session import big, cut, shuffle_width, spaced

LEAST = 0.62
SLACK = 0.02
ADDRESS_PARTS = ("number", "direction", "mark", "street", "stype", "city", "zip", "zip_city")
NAME_PARTS = ("rare", "common", "given", "nmark", "ntype", "part", "phase")
#: Letters in a rare piece of a street and of a name.
STREET_GRAM, NAME_GRAM = 2, 4
#: Rows of one leading key in one task; longer runs are cut into blocks, and every two blocks meet.
RUN = 4096
#: What tells properties of one component apart, besides the name's words.
SIGN = ("number", "direction", "mark", "stype", "ntype", "part", "phase")
#: Leading keys of long runs that may be sent to every task.
MOST_HOT = 100_000


def _describe(rows: DataFrame, refs: DataFrame) -> DataFrame:
    """Distinct ``name, agency, address`` of both sources with all pieces and ``rep``."""
    reps = cut(rows.select("name", "agency", "address").distinct())
    places = cut(address_pieces(reps))
    cities = F.broadcast(zip_cities(places))  # a row for each five-digit code at most
    return (
        reps.join(
            big(name_pieces(reps).select("name", "rare", "common", "given", F.col("mark").alias("nmark"), "ntype", "part", "phase")),
            "name",
        )
        .join(big(agency_keys(reps, refs)), "agency")
        .join(big(places.join(cities, "zip", "left").withColumn("zip_city", F.coalesce("zip_city", F.lit("")))), "address")
        .withColumn("rep", F.xxhash64("name", "agency", "address"))
    )


def _letters(word: str) -> int:
    """A signed 64-bit set of neighbouring letters; each slip touches three at most."""
    bits = 0
    for k in range(len(word) - 1):
        bits |= 1 << ((ord(word[k]) * 31 + ord(word[k + 1])) % 64)
    return bits - (1 << 64) if bits >> 63 else bits


def sort_rows(reps: DataFrame, longest: int = RUN) -> DataFrame:
    """A row for each composite key of each record: ``lead, tail`` (the key), ``rep`` and compact marks for the window.

    ``flags`` holds the side (1 left, 2 right, 3 both) and whether the record has no
    rare word, has a number, and whether the row is of a name order. One leading key
    may hold any share of the rows: a longer run than ``longest`` is cut into blocks,
    and each row goes to every two blocks (``one, two``) with its ``own``.
    """
    base = cut(spaced(reps.select("rep", "side", "number", "street", "zip", "rare", "common", "body")))

    def streets(pdf: pd.DataFrame) -> list[str]:
        return list(pdf["street"].where(pdf["number"] != "", ""))

    def words(pdf: pd.DataFrame) -> list[str]:
        """The rare word of each name, then both words as one."""
        return list(pdf["rare"]) + list((pdf["rare"] + pdf["common"]).where(pdf["rare"] != "", ""))

    context = base.sparkSession.sparkContext
    shared = context.broadcast((piece_counts(base, streets, STREET_GRAM), piece_counts(base, words, NAME_GRAM)))  # bounded, see piece_counts

    def leads_of(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
        """Row and leading key of each order the records stand in; so many of them are of the address order, which come first."""
        of_street, of_name = shared.value
        numbers = pd.to_numeric(pdf["number"], errors="coerce").fillna(-1).to_numpy(np.int64)
        at, piece = prefixes(streets(pdf), STREET_GRAM, of_street)
        word, gram = prefixes(words(pdf), NAME_GRAM, of_name)
        lead = np.concatenate([keys_of(numbers[at], piece), keys_of(-1 - word // len(pdf), gram)])
        return np.concatenate([at, word % len(pdf)]), lead, len(at)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lead, n = np.unique(leads_of(pdf)[1], return_counts=True)
            yield pd.DataFrame({"lead": lead, "n": n})

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            index, lead, upto = leads_of(pdf)
            named = np.arange(len(index)) >= upto
            zips = pd.to_numeric(pdf["zip"], errors="coerce").fillna(0).to_numpy(np.int64)
            # 0 says nothing; bodies outside the reference list may be misspelt themselves.
            body = np.array([0 if not b else 1 if b[0] == "~" else zlib.crc32(b.encode()) for b in pdf["body"]], np.int64)
            flags = (pdf["side"] + 4 * (pdf["rare"] == "") + 8 * (pdf["number"] != "")).to_numpy(np.int32)
            tails = [np.array([_first_letters(t) for t in x], np.int64) for x in (pdf["street"], pdf["rare"])]
            yield pd.DataFrame(
                {
                    "lead": lead,
                    "tail": np.where(named, tails[1][index], tails[0][index]),
                    "rep": pdf["rep"].to_numpy()[index],
                    "flags": flags[index] + 16 * named.astype(np.int32),
                    "part": (zips << 32 | body)[index],
                    "rare_bits": np.array([_letters(w) for w in pdf["rare"]], np.int64)[index],
                    "both_bits": np.array([_letters(w) for w in pdf["rare"] + pdf["common"]], np.int64)[index],
                }
            )

    rows = base.mapInPandas(spread, "lead long, tail long, rep long, flags int, part long, rare_bits long, both_bits long")
    hot = cut(
        base.mapInPandas(count, "lead long, n long").groupBy("lead").agg(F.sum("n").alias("n")).where(F.col("n") > longest).select("lead", F.ceil(F.col("n") / longest).cast("int").alias("blocks"))
    )
    spare = hot.count()
    if spare:
        rows = rows.join(F.broadcast(hot) if spare <= MOST_HOT else big(hot), "lead", "left")
    else:
        rows = rows.withColumn("blocks", F.lit(None).cast("int"))
    n = F.coalesce("blocks", F.lit(1))
    return (
        rows.withColumn("own", F.pmod(F.xxhash64("rep"), n).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
        .withColumn("one", F.least("own", "other"))
        .withColumn("two", F.greatest("own", "other"))
        .drop("blocks", "other")
    )


def _first_letters(word: str) -> int:
    """The first letters of a word as a number in the same order."""
    return int.from_bytes(word[:7].encode("ascii", "replace").ljust(7, b"\0"))


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether two sets of letter pairs may be those of words two slips apart."""
    return (np.bitwise_count(a & ~b) <= 6) & (np.bitwise_count(b & ~a) <= 6)


def window_pairs(run: dict[str, np.ndarray], most: int = 1 << 20) -> np.ndarray:
    """Pairs (left, right) that a window lets through which slides over sorted rows as far as ``run`` stays the same.

    Rows without a number come first in a run of the name orders, which are for
    pairs of which one has none: the window opens at those alone. About ``most``
    places of the window are looked at at once.
    """
    ends = np.searchsorted(run["run"], run["run"], side="right")
    reach = ends - np.arange(len(ends)) - 1
    left, right, nameless, numbered, named = (run["flags"] & k > 0 for k in (1, 2, 4, 8, 16))
    zips, body = run["part"] >> 32, run["part"] & 0xFFFFFFFF
    reach[named & numbered] = 0
    total = np.cumsum(reach)
    found = [np.zeros((0, 2), np.int64)]
    first = 0
    while first < len(reach):
        upto = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + most, side="right")))
        n = reach[first:upto]
        i = np.repeat(np.arange(first, upto), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        first = upto
        ok = (left[i] & right[j]) | (right[i] & left[j])
        i, j = i[ok], j[ok]
        ok = (body[i] == body[j]) | (body[i] == 0) | (body[j] == 0)
        ok &= (zips[i] == zips[j]) | (zips[i] == 0) | (zips[j] == 0)
        i, j = i[ok], j[ok]
        ok = (run["own"][i] != run["own"][j]) | (run["one"][i] == run["two"][i])
        ok &= nameless[i] | nameless[j] | _near(run["rare_bits"][i], run["rare_bits"][j]) | _near(run["both_bits"][i], run["both_bits"][j])
        i, j = i[ok], j[ok]
        for x, y in ((i, j), (j, i)):
            fit = left[x] & right[y]
            found.append(np.unique(np.stack([run["rep"][x[fit]], run["rep"][y[fit]]], 1), axis=0))
    both = run["rep"][left & right]
    found.append(np.stack([both, both], 1))
    return np.unique(np.concatenate(found), axis=0)


def candidates(reps: DataFrame, longest: int = RUN) -> DataFrame:
    """All pairs of different sides that ``confidence`` may accept: ``left, right``, each once."""
    rows = sort_rows(reps, longest)
    keys = ("lead", "one", "two")
    # Within a key, records without a number come first, see window_pairs.
    ordered = rows.repartition(shuffle_width(rows.sparkSession), *keys).sortWithinPartitions(*keys, F.col("flags").bitwiseAND(8), "tail", "rep").drop("tail")
    names = [c for c in ordered.columns]

    def slide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: pd.DataFrame | None = None

        def pairs_of(pdf: pd.DataFrame) -> pd.DataFrame:
            # Bits of a negative number would be counted without its sign.
            run = {c: pdf[c].to_numpy().view(np.uint64) if c.endswith("_bits") else pdf[c].to_numpy() for c in names}
            changed = np.zeros(len(pdf), bool)
            for c in keys:
                changed[1:] |= run[c][1:] != run[c][:-1]
            run["run"] = np.cumsum(changed)
            return pd.DataFrame(window_pairs(run), columns=["left", "right"])

        for pdf in batches:
            pdf = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
            if not len(pdf):
                continue
            # The last run may go on in the next batch.
            last = pdf.iloc[-1]
            open_run = ((pdf["lead"] == last["lead"]) & (pdf["one"] == last["one"]) & (pdf["two"] == last["two"])).to_numpy()
            kept = pdf[open_run]
            if not open_run.all():
                yield pairs_of(pdf[~open_run])
        if kept is not None and len(kept):
            yield pairs_of(kept)

    return ordered.mapInPandas(slide, "left long, right long").distinct()


def confidence(x: dict, y: dict) -> float:
    """Confidence that two records are one property; 0 where any part speaks against it.

    Weights: name 0.5, address 0.35, agency 0.15. What one side does not say earns
    half its weight at most.
    """
    if not givens_agree(x["given"], y["given"]) or (x["nmark"] and y["nmark"] and x["nmark"] != y["nmark"]):
        return 0.0
    named = bool(x["rare"] or x["common"]) and bool(y["rare"] or y["common"])
    # A name cut down to its rare word leaves kind, part and phase open.
    cut_x, cut_y = not (x["ntype"] or x["part"] or x["phase"] or x["common"]), not (y["ntype"] or y["part"] or y["phase"] or y["common"])
    if named and not cut_x and not cut_y:
        if x["phase"] != y["phase"]:
            return 0.0
        open_x, open_y = not (x["ntype"] or x["part"]), not (y["ntype"] or y["part"])
        if not (open_x or open_y) and (x["part"] != y["part"] or (x["ntype"] and y["ntype"] and x["ntype"] != y["ntype"])):
            return 0.0
    score = 0.0
    whole = False
    if named:
        both_rare = x["rare"] and y["rare"]
        words = words_agree(x["rare"], x["common"], y["rare"], y["common"])
        if words == 0.0 or (not both_rare and not (x["common"] and y["common"])):
            return 0.0
        whole = bool(both_rare)
        score += 0.5 * words if whole else 0.3
        if x["ntype"] and y["ntype"] and x["ntype"] == y["ntype"] and x["part"] == y["part"]:
            score += 0.02
        elif not cut_x and not cut_y:
            score -= 0.03
    else:
        score += 0.12
    a = Address(*(x[c] for c in ADDRESS_PARTS[:-1]))
    b = Address(*(y[c] for c in ADDRESS_PARTS[:-1]))
    city = cities_agree(a, b, x["zip_city"], y["zip_city"])
    if city is False:
        return 0.0
    at = False
    if a.number and b.number:
        if a.number != b.number or not words_alike(a.street, b.street):
            return 0.0
        for p, q in ((a.direction, b.direction), (a.type, b.type), (a.mark, b.mark)):
            if p and q and p != q:
                return 0.0
            score += 0.01 * (p == q)
        score += 0.28 + (0.04 if city else 0.0)
        at = True
    else:
        score += 0.12 + (0.06 if city else 0.0)
    body = bodies_agree(x["body"], y["body"])
    if body is False:
        return 0.0
    score += 0.15 if body else 0.06
    if not whole and not at:
        return 0.0
    return round(min(score, 1.0), 4)


def _compatible(x: list[str], y: tuple[str, ...]) -> bool:
    """Whether two signs can be of one property; a missing part says nothing, but a phase told by one alone does unless a name is cut down."""
    if any(a and b and a != b for a, b in zip(x[:5], y[:5])):
        return False
    if not any(x[4:]) or not any(y[4:]):
        return True
    return x[5:] == list(y[5:])


def properties(signs: dict[str, float]) -> tuple[list[list[str]], set[str]]:
    """The signs of one side of a component as properties, and the signs that leave open which of several they are.

    Signs that say most come first; each joins the one property it does not
    contradict, or makes one of its own. Among those that say as much the more confident come first.
    """
    told = sorted(signs, key=lambda s: (-sum(bool(p) for p in s.split("|")), -signs[s], s))
    groups: list[tuple[list[str], list[str]]] = []
    torn = set()
    for sign in told:
        parts = tuple(sign.split("|"))
        fits = [g for g in groups if _compatible(g[0], parts)]
        if len(fits) > 1:
            torn.add(sign)
        elif fits:
            profile, members = fits[0]
            members.append(sign)
            profile[:] = [a or b for a, b in zip(profile, parts)]
        else:
            groups.append((list(parts), [sign]))
    return [m for _, m in groups], torn


def assign(edges: list[tuple[str, str, float]]) -> list[tuple[str, str, bool, bool]]:
    """What a component keeps of its matches between signs, ``(left, right, left is torn, right is torn)``: those of the assignment of properties, and all of torn signs."""
    tops: tuple[dict[str, float], dict[str, float]] = ({}, {})
    for x, y, best in edges:
        tops[0][x] = max(best, tops[0].get(x, 0.0))
        tops[1][y] = max(best, tops[1].get(y, 0.0))
    (lefts, torn_left), (rights, torn_right) = properties(tops[0]), properties(tops[1])
    row = {s: k for k, g in enumerate(lefts) for s in g}
    column = {s: k for k, g in enumerate(rights) for s in g}
    weight = np.zeros((len(lefts), len(rights)))
    for x, y, best in edges:
        if x in row and y in column:
            weight[row[x], column[y]] = max(weight[row[x], column[y]], best)
    chosen = set(best_assignment(weight))
    out = []
    for x, y, _ in edges:
        torn = x in torn_left, y in torn_right
        if any(torn) or (row[x], column[y]) in chosen:
            out.append((x, y, *torn))
    return out


def assigned(scored: DataFrame, signs: DataFrame) -> DataFrame:
    """The pairs ``left, right, confidence`` of ``scored`` that the assignment keeps; ``signs`` has ``rep, sign``.

    A component goes to one task as its different pairs of signs only, however many records it has.
    """
    comps = components(scored.select(F.col("left").alias("a"), F.col("right").alias("b")))
    told = scored.join(big(comps.select(F.col("node").alias("left"), "component")), "left")
    for side in ("left", "right"):
        told = told.join(big(signs.select(F.col("rep").alias(side), F.col("sign").alias(f"sign_{side}"))), side)
    told = cut(told)
    groups = told.groupBy("component", "sign_left", "sign_right").agg(F.max("confidence").alias("best"))
    ordered = groups.repartition(shuffle_width(scored.sparkSession), "component").sortWithinPartitions("component", "sign_left", "sign_right")

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, edges, names = None, [], ["component", "sign_left", "sign_right", "torn_left", "torn_right"]
        for pdf in batches:
            rows = []
            for component, x, y, best in pdf[["component", "sign_left", "sign_right", "best"]].itertuples(index=False):
                if component != now:
                    rows += [(now, *k) for k in assign(edges)]
                    now, edges = component, []
                edges.append((x, y, best))
            yield pd.DataFrame(rows, columns=names)
        yield pd.DataFrame([(now, *k) for k in assign(edges)], columns=names)

    kept = told.join(
        big(ordered.mapInPandas(solve, "component long, sign_left string, sign_right string, torn_left boolean, torn_right boolean")), ["component", "sign_left", "sign_right"]
    )
    best = kept.select(
        "left",
        "right",
        "confidence",
        "torn_left",
        "torn_right",
        F.max("confidence").over(Window.partitionBy("left")).alias("best_left"),
        F.max("confidence").over(Window.partitionBy("right")).alias("best_right"),
    )
    return best.where(
        (~F.col("torn_left") | (F.col("confidence") >= F.col("best_left") - SLACK))
        & (~F.col("torn_right") | (F.col("confidence") >= F.col("best_right") - SLACK))
    ).select("left", "right", "confidence")


def match_records(left: DataFrame, right: DataFrame, refs: DataFrame) -> DataFrame:
    """Matching pairs of two sources: ``left_id, right_id, confidence``.

    Both sides have ``id, name, agency, address`` (missing as empty text); other
    columns are ignored. Equal records are compared once and all keep their match.
    Records with neither name nor address match nothing. Empty sides give no rows.
    """
    both = left.select("id", "name", "agency", "address", F.lit(1).alias("side")).unionByName(
        right.select("id", "name", "agency", "address", F.lit(2).alias("side"))
    )
    # Texts of equal pieces are one record of the orders; their ids follow by ``members``.
    parts = (*NAME_PARTS, *ADDRESS_PARTS, "body")
    described = cut(
        _describe(both, refs)
        .where("rare != '' OR common != '' OR number != ''")
        .select(F.col("rep").alias("texts"), F.xxhash64(*parts).alias("rep"), *parts)
    )
    members = cut(
        both.select("side", "id", F.xxhash64("name", "agency", "address").alias("texts")).join(big(described.select("texts", "rep")), "texts").select("side", "id", "rep")
    )
    sides = members.groupBy("rep").agg(F.expr("bit_or(side)").alias("side"))
    reps = cut(described.drop("texts").dropDuplicates(["rep"]).join(big(sides), "rep"))
    facts = reps.select("rep", F.struct(*parts).alias("f"))
    pairs = candidates(reps).join(big(facts.select(F.col("rep").alias("left"), F.col("f").alias("x"))), "left").join(
        big(facts.select(F.col("rep").alias("right"), F.col("f").alias("y"))), "right"
    )

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[["left", "right"]].assign(confidence=[confidence(x, y) for x, y in zip(pdf["x"], pdf["y"])])
            yield out[out["confidence"] >= LEAST]

    scored = cut(pairs.select("left", "right", "x", "y").mapInPandas(score, "left long, right long, confidence double"))
    kept = assigned(scored, reps.select("rep", F.concat_ws("|", *SIGN).alias("sign")))
    return (
        kept.join(big(members.where("side = 1").select(F.col("rep").alias("left"), F.col("id").alias("left_id"))), "left")
        .join(big(members.where("side = 2").select(F.col("rep").alias("right"), F.col("id").alias("right_id"))), "right")
        .select("left_id", "right_id", "confidence")
    )


def raw_side(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("record_id").cast("long").alias("id"),
        said("property_name").alias("name"),
        said("authority").alias("agency"),
        said("address").alias("address"),
    )


def partner_side(partners: DataFrame) -> DataFrame:
    parts = [F.nullif(F.trim(c), F.lit("")) for c in ("street_address", "city", "zip_code")]
    return partners.select(
        F.col("partner_id").cast("long").alias("id"),
        said("building_name").alias("name"),
        said("agency").alias("agency"),
        F.concat_ws(", ", *parts).alias("address"),
    )
