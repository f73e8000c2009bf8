"""Typed names, addresses and agency labels taken apart into comparable pieces.

Everything here is plain Python on one value; operators run it over distinct
values in Arrow batches. NULL, blank and unreadable values give empty pieces.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from typing import NamedTuple

# Usual abbreviations and spellings, word by word.
NAME_TYPES = {
    "apartments": "apartments apartment apts apt aptmts aptmt appartments appartment apmts",
    "housing": "housing hsg hous housng",
    "homes": "homes home hms",
    "townhomes": "townhomes townhome townhms townhouses townhouse th ths",
    "village": "village vlg vill villag villages",
    "gardens": "gardens garden gdns gdn grdns",
    "court": "court crt ct courts",
    "plaza": "plaza plz pl plza",
    "terrace": "terrace ter terr tce terraces",
    "manor": "manor mnr mannor manors",
    "residences": "residences residence resid res resids",
    "commons": "commons common cmns comm cmn",
    "lofts": "lofts loft lfts lft",
    "studios": "studios studio stud studs",
    "villas": "villas villa",
    "estates": "estates estate ests est",
    "towers": "towers tower twr twrs",
    "flats": "flats flat",
}
NAME_PARTS = {
    "senior": "senior seniors sr snr srs",
    "family": "family families fam fams",
    "veterans": "veterans veteran vets",
    "supportive": "supportive",
}
MARKS = {"saint": "saint st", "mount": "mount mt", "fort": "fort ft"}
STREET_TYPES = {
    "street": "street st str strt",
    "avenue": "avenue ave av aven avnue",
    "drive": "drive dr drv",
    "road": "road rd",
    "boulevard": "boulevard blvd bl boul bvd",
    "lane": "lane ln",
    "court": "court ct crt",
    "place": "place pl plc",
    "way": "way wy",
    "circle": "circle cir circ crcl",
    "terrace": "terrace ter terr tce",
    "parkway": "parkway pkwy pky pkway",
    "highway": "highway hwy",
    "square": "square sq",
    "trail": "trail trl",
    "alley": "alley aly",
}
DIRECTIONS = {
    "north": "north n no",
    "south": "south s so",
    "east": "east e",
    "west": "west w",
    "northeast": "northeast ne",
    "northwest": "northwest nw",
    "southeast": "southeast se",
    "southwest": "southwest sw",
}
GIVEN_NAMES = {
    "alexander": "alexander alex al sandy",
    "charles": "charles charlie chas chuck",
    "dorothy": "dorothy dot dottie dolly",
    "edward": "edward ed eddie edw ned",
    "elizabeth": "elizabeth liz beth betty eliza lizzie eliz",
    "francisco": "francisco frank paco pancho fco",
    "guadalupe": "guadalupe lupe lupita",
    "james": "james jim jimmy jas",
    "josephine": "josephine jo josie",
    "katherine": "katherine kate kathy katie kath",
    "margaret": "margaret maggie peggy meg marge",
    "richard": "richard dick rich rick",
    "robert": "robert bob rob bobby robt",
    "theodore": "theodore theo ted teddy",
    "thomas": "thomas tom thos tommy",
    "william": "william will bill wm billy",
    "john": "john jack jn",
    "joseph": "joseph joe jos",
    "mary": "mary molly",
    "george": "george geo",
    "michael": "michael mike mick",
    "patricia": "patricia pat patty",
}
ROMAN = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5", "vi": "6", "one": "1", "two": "2", "three": "3"}
NO_ADDRESS = {"request", "tbd", "tba", "call", "contact", "various", "available", "website", "online", "unknown", "na", "confidential", "undisclosed", "scattered", "multiple", "see", "address"}
STATE_WORDS = {"ca", "calif", "california", "usa", "us"}


def _inverse(groups: dict[str, str]) -> dict[str, str]:
    return {word: name for name, words in groups.items() for word in words.split()}


TYPE_OF, PART_OF, MARK_OF = _inverse(NAME_TYPES), _inverse(NAME_PARTS), _inverse(MARKS)
STREET_OF, DIRECTION_OF, GIVEN_OF = _inverse(STREET_TYPES), _inverse(DIRECTIONS), _inverse(GIVEN_NAMES)
GIVEN_OF["ted"] = "edward|theodore"
_INVISIBLE = re.compile("[­​-‏ -‮⁠-⁤﻿]")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def plain(text: str | None) -> str:
    """Compatibility form without accents and invisible characters; NULL is empty."""
    if not text:
        return ""
    if text.isascii():
        return text
    text = _INVISIBLE.sub("", unicodedata.normalize("NFKD", text))
    return "".join(c for c in text if not unicodedata.combining(c))


def distance(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours (optimal string alignment); most + 1 if larger."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


def alike(a: str, b: str) -> bool:
    """The same word up to typing slips: one in a short word, two from eight letters on."""
    if a == b:
        return True
    short = min(len(a), len(b))
    if short < 4:
        return False
    most = 2 if short >= 8 else 1
    return distance(a, b, most) <= most


def _shortened(word: str, most: int) -> set[str]:
    """A word without up to ``most`` of its letters, in every way."""
    out = last = {word}
    for _ in range(most):
        last = {w[:k] + w[k + 1 :] for w in last for k in range(len(w))}
        out = out | last
    return out


class SlipIndex:
    """Known words found from typed ones up to ``most`` slips.

    Two words within ``e`` slips have a form in common when each drops up to ``e``
    letters, so a look-up compares the few known words that share one.
    """

    def __init__(self, known: dict[str, str], most: int, least: int = 0):
        self.known, self.most, self.least = known, most, least
        self.forms: dict[str, list[str]] = {}
        for word in known:
            if len(word) >= least:
                for form in _shortened(word, most):
                    self.forms.setdefault(form, []).append(word)

    def near(self, word: str) -> list[tuple[int, str]]:
        """Known words within ``most`` slips, with their distance."""
        found = {k for form in _shortened(word, self.most) for k in self.forms.get(form, ())}
        near = ((distance(word, k, self.most), k) for k in found)
        return sorted(x for x in near if x[0] <= self.most)


@lru_cache
def _index(kinds: str) -> SlipIndex:
    return SlipIndex({"type": TYPE_OF, "part": PART_OF, "street": STREET_OF, "direction": DIRECTION_OF, "given": GIVEN_OF}[kinds], 1, 5)


@lru_cache(200_000)
def _near(word: str, kinds: str) -> str | None:
    """The vocabulary word that a longer ``word`` misses by one slip."""
    index = _index(kinds)
    if word in index.known:
        return index.known[word]
    if len(word) < 5 or not (found := index.near(word)):
        return None
    # Of several the one that stands first in the vocabulary.
    order = list(index.known)
    return index.known[min((k for _, k in found), key=order.index)]


class Name(NamedTuple):
    """A property name: ``words`` are what is left when the rest is taken off."""

    words: tuple[str, ...]
    given: str
    mark: str
    type: str
    part: str
    phase: str


_NOTE = re.compile(
    r"\(.*?\)|\b\d+\s+(?:available\s+)?units?(?:\s+available)?\b|\bbmr\b(?:\s+(?:rentals?|units?|program))?|\bbelow market rate\b"
)
_PHASE = re.compile(r"\b(?:phase|phas|phse|phsae|pahse|phaes|ph)\b\.?\s*(?:no\.?\s*)?(iii|ii|iv|i|vi|v|one|two|three|\d)\b")


@lru_cache(100_000)
def parse_name(text: str | None) -> Name:
    """A property name taken apart; empty pieces where it says nothing."""
    s = _CAMEL.sub(" ", plain(text)).lower().replace("–", " ").replace("'", "")
    s = _NOTE.sub(" ", s)
    phase = ""
    if m := _PHASE.search(s):
        phase = ROMAN.get(m[1], m[1])
        s = s[: m.start()] + " " + s[m.end() :]
    s = re.sub(r"\btown\s+(homes?|hms|houses?)\b", "townhomes", s)
    tokens = re.findall(r"[^\W_]+", s)
    if len(tokens) > 1 and not phase and tokens[-1] in ROMAN and tokens[-1] not in ("v", "i"):
        phase = ROMAN[tokens.pop()]
    if tokens and tokens[0] == "the":
        tokens = tokens[1:]
    if "at" in tokens[1:4]:
        k = tokens.index("at", 1)
        head = tokens[:k]
        if all(_near(t, "type") or _near(t, "part") for t in head):
            tokens = tokens[k + 1 :] + head
    tokens = [t for t in tokens if t not in ("the", "at", "of", "and")]
    given = mark = ""
    # A given name stands first, or last where the rest was put before it.
    for k in dict.fromkeys((0, len(tokens) - 1)):
        if tokens and len(tokens) > 1 and k < len(tokens) and (found := _near(tokens[k], "given")):
            given = found
            tokens = tokens[:k] + tokens[k + 1 :]
            break
    for k, t in enumerate(tokens[:-1]):
        if t in MARK_OF and k == 0:
            mark = MARK_OF[t]
            tokens = tokens[1:]
            break
    kind, parts = "", []
    while len(tokens) > 1:
        t = tokens[-1]
        if not kind and not parts and (found := TYPE_OF.get(t) or (_near(t, "type") if len(tokens) > 2 or len(t) > 6 else None)):
            kind = found
        elif found := PART_OF.get(t) or (_near(t, "part") if len(tokens) > 2 else None):
            parts.append(found)
        else:
            break
        tokens.pop()
    return Name(tuple(tokens), given, mark, kind, " ".join(sorted(set(parts))), phase)


class Address(NamedTuple):
    """A postal address; ``street`` is the bare name, ``city`` may hold a trailing street word if no comma parts them."""

    number: str
    direction: str
    mark: str
    street: str
    type: str
    city: str
    zip: str


_UNIT = re.compile(
    r"(?:\b(?:apt|apartment|unit|ste|suite|bldg|building|rm|room|spc|space)\b\.?\s*#?\s*(?:no\.?\s*)?[a-z]?-?\d*[a-z]?\b|#\s*\d*[a-z]?\b)"
)
_ZIP = re.compile(r"\b(\d{5})(?:-\d{4})*(?=\D*$)|\b(\d{5})(?:-\d{4})*\b")


def _street(tokens: list[str]) -> tuple[str, str, str, str, list[str]]:
    """direction, mark, bare name, type, and what follows the type."""
    direction = mark = kind = ""
    if len(tokens) > 1 and (found := DIRECTION_OF.get(tokens[0]) or _near(tokens[0], "direction")):
        direction, tokens = found, tokens[1:]
    if len(tokens) > 1 and tokens[0] in MARK_OF:
        mark, tokens = MARK_OF[tokens[0]], tokens[1:]
    rest = []
    for k in range(1, len(tokens)):
        if found := STREET_OF.get(tokens[k]) or _near(tokens[k], "street"):
            kind, rest, tokens = found, tokens[k + 1 :], tokens[:k]
            break
    # The direction may stand behind name or type.
    if not direction and rest and rest[0] in DIRECTION_OF:
        direction, rest = DIRECTION_OF[rest[0]], rest[1:]
    if not direction and len(tokens) > 1 and tokens[-1] in DIRECTION_OF:
        direction, tokens = DIRECTION_OF[tokens[-1]], tokens[:-1]
    return direction, mark, " ".join(tokens), kind, rest


@lru_cache(100_000)
def parse_address(text: str | None) -> Address:
    """An address taken apart, whatever the order of its parts; without street and number ``number`` is empty."""
    s = plain(text).lower()
    # A line break, a semicolon or a spaced dash parts as a comma does.
    s = re.sub(r"\s+-\s+|[;\n\r|]+", ",", s)
    zip_code, zip_last = "", False
    zips = [m for m in re.finditer(r"(?<![\d#-])(\d{5})(?:-\d{4})*(?![\d])", s)]
    if zips:
        m = zips[-1]
        zip_code = m[1]
        zip_last = not re.search(r"[^\W_]", s[m.end() :])
        s = s[: m.start()] + "," + s[m.end() :]
    s = _UNIT.sub(" , ", s)
    segments = []
    for part in s.split(","):
        tokens = [t for t in re.findall(r"[^\W_]+", part)]
        while tokens and tokens[-1] in STATE_WORDS:
            tokens.pop()
        while tokens and tokens[0] in ("california", "calif", "usa") or tokens == ["ca"]:
            tokens = tokens[1:]
        if tokens:
            segments.append(tokens)
    number = ""
    at = -1
    for k, tokens in enumerate(segments):
        digits = [j for j, t in enumerate(tokens) if re.fullmatch(r"\d{1,5}[a-z]?", t)]
        if digits:
            j = digits[0]
            number, at = re.match(r"\d+", tokens[j])[0], k
            before, after = tokens[:j], tokens[j + 1 :]
            if before and before[-1] in ("no", "nr", "num", "number"):
                before = before[:-1]
            break
    if at < 0:
        # City alone, or a phrase in place of an address.
        says = segments[-1] if segments else []
        return Address("", "", "", "", "", "" if set(says) & NO_ADDRESS else " ".join(says), zip_code)
    if before and after:
        # Street before the number: what follows is the city.
        direction, mark, street, kind, _ = _street(before)
        rest = [after] + segments[at + 1 :]
        other = segments[:at]
    elif after and at and len(after) == 1 and (zip_last or any(t in STREET_OF for t in segments[at - 1][1:])):
        # Street, then number and city.
        direction, mark, street, kind, tail = _street(segments[at - 1])
        rest, other = [after] + segments[at + 1 :], segments[: at - 1]
    elif after:
        direction, mark, street, kind, tail = _street(after)
        rest = ([tail] if tail else []) + segments[at + 1 :]
        other = segments[:at]
    elif before:
        direction, mark, street, kind, _ = _street(before)
        rest, other = segments[at + 1 :], segments[:at]
    else:
        # The number alone: its street is the segment before it, or behind it.
        near = at - 1 if at else at + 1
        if not 0 <= near < len(segments):
            return Address("", "", "", "", "", "", zip_code)
        direction, mark, street, kind, tail = _street(segments[near])
        rest = ([tail] if tail else []) + [x for k, x in enumerate(segments) if k not in (at, near) and k > min(at, near)]
        other = [x for k, x in enumerate(segments) if k < min(at, near)]
    places = [" ".join(t for t in x if not t.isdigit()) for x in rest + other]
    places = [p for p in places if p]
    city = places[0] if places else ""
    if not city and not kind and street.count(" ") == 1:
        # No comma and no street word: the city is the last word.
        street, city = street.split()
    street = street.replace(" ", "")
    if not street:
        number = ""
    return Address(number, direction, mark, street, kind, city, zip_code)


class Agency(NamedTuple):
    """An agency label: what kind of body, and the words of its own name in order of the alphabet."""

    kind: str
    core: tuple[str, ...]


_AGENCY_WORDS = {
    "city": "city cty c",
    "town": "town twn t",
    "county": "county cnty",
    "housing": "housing hsg housng hous",
    "authority": "authority auth athority",
    "office": "office off",
    "supportive": "supportive supp",
    "osh": "osh",
    "ha": "ha",
    "cdc": "cdc",
    "community": "community comm cmty",
    "development": "development dev developement devel",
    "corporation": "corporation corp",
    "management": "management mgmt mgt",
    "company": "company",
    "co": "co",
    "inc": "inc incorporated llc",
    "dept": "dept department",
    "noise": "the of and for portfolio ca calif california",
}
AGENCY_OF = _inverse(_AGENCY_WORDS)
#: Labels that say nothing, as text without case and punctuation.
NO_AGENCY = set("na|none|null|various|multiple cities|private|see notes|unknown agency|unknown|tbd|not stated|other|multiple|private owner|owner agent|see website|varies|n a|agent|owner".split("|"))


@lru_cache
def _agency_index() -> SlipIndex:
    return SlipIndex(AGENCY_OF, 1, 6)


@lru_cache(100_000)
def _agency_word(word: str) -> str | None:
    if word in AGENCY_OF:
        return AGENCY_OF[word]
    if len(word) < 5 or not (found := _agency_index().near(word)):
        return None
    order = list(AGENCY_OF)
    return AGENCY_OF[min((k for _, k in found), key=order.index)]


@lru_cache(100_000)
def parse_agency(text: str | None) -> Agency:
    """An agency label taken apart; labels that say nothing have no core and no kind."""
    s = _CAMEL.sub(" ", plain(text)).lower()
    s = re.sub(r"\(([^)]*)\)", lambda m: f" {m[1]} " if m[1].strip() in ("city", "town", "county") else " ", s)
    tokens = re.findall(r"[^\W_]+", s.replace("'", ""))
    if " ".join(tokens) in NO_AGENCY or not tokens:
        return Agency("", ())
    kinds, core = set(), []
    for t in tokens:
        known = _agency_word(t)
        if known is None and t.startswith("of") and len(t) > 6 and kinds & {"city", "town"}:
            t = t[2:]
        elif known is None and len(t) > 10:
            # Glued to the last word: "xyzhousing".
            for tail in ("housing", "management"):
                if t.endswith(tail) and len(t) - len(tail) >= 4:
                    t = t[: -len(tail)]
                    kinds.add(tail)
        if known:
            kinds.add(known)
        else:
            core.append(t)
    if "management" in kinds or "company" in kinds:
        kind = "manager"
    elif "cdc" in kinds or kinds & {"community", "development"}:
        kind = "development"
    elif "osh" in kinds or kinds & {"office", "supportive"}:
        kind = "office"
    elif "authority" in kinds or "ha" in kinds:
        kind = "authority"
    elif "city" in kinds:
        kind = "city"
    elif "town" in kinds:
        kind = "town"
    elif kinds & {"county", "co"} and "housing" not in kinds:
        kind = "county"
    elif "housing" in kinds:
        kind = "housing"
    else:
        kind = ""
    return Agency(kind, tuple(sorted(core)))
