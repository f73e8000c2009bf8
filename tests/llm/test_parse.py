import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rollbook.llm import parse
from rollbook.llm.pieces import bodies_agree, place_score, words_agree


def plain_distance(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=7), st.text("abc", max_size=7), st.integers(0, 4))
def test_distance(a, b, most):
    n = plain_distance(a, b)
    assert parse.distance(a, b, most) == (n if n <= most else most + 1)


SAME = [
    "1004 East Hirkodaclack Avenue, Thandutadare, CA 95468",
    "1004 E. Hirkodaclack Ave Bldg 2, Thandutadare, CA 95468",
    "East Hirkodaclack Av 1004, Thandutadare",
    "Thandutadare, CA 95468, 1004 East Hirkodaclack Avenue",
    "1004 east hirkodaclack avenue\nthandutadare\nca 95468-1234",
    "East Hirkodaclack Avenue No. 1004, Thandutadare, Calif. 95468",
    "1004 Hirkodaclack East, Thandutadare",
    "1004 Hirkodaclak; CA 95468",
]


def test_wordings_of_one_address():
    first = parse.parse_address(SAME[0])
    assert first == parse.Address("1004", "east", "", "hirkodaclack", "avenue", "thandutadare", "95468")
    for text in SAME[1:]:
        assert place_score(first, parse.parse_address(text), "thandutadare", "thandutadare"), text


@pytest.mark.parametrize(
    "other",
    ["1014 East Hirkodaclack Avenue, Thandutadare", "1004 West Hirkodaclack Avenue, Thandutadare", "1004 East Hirkodaclack Lane, Thandutadare", "1004 East Hirkodaclack Avenue, Pivovhey", "1004 East Strundonast Avenue, Thandutadare"],
)
def test_other_places(other):
    assert place_score(parse.parse_address(SAME[0]), parse.parse_address(other), "thandutadare", "") == 0.0


@pytest.mark.parametrize("text", [None, "", "   ", "Address on request", "Thandutadare, CA", "CA", "95468", "#5", ",,;;\n", "x" * 50_000, "9" * 50_000, "1 " * 20_000])
def test_no_street(text):
    assert place_score(parse.parse_address(text), parse.parse_address(SAME[0])) in (None, 0.0)


@pytest.mark.parametrize(
    "text,wanted",
    [
        ("The Plalurgosk-Cannery", (("plalurgosk", "cannery"), "", "", "", "", "")),
        ("Senior Apartments at Oakwood Heron", (("oakwood", "heron"), "", "", "apartments", "senior", "")),
        ("Fetovemomb Magnolia Fam. Apts, William", (("fetovemomb", "magnolia"), "william", "", "apartments", "family", "")),
        ("Mt. Sledegiblelt Crossing Ph. II (BMR)", (("sledegiblelt", "crossing"), "", "mount", "", "", "2")),
        ("StistesapimPromenade Town Homes - 13 available units", (("stistesapim", "promenade"), "", "", "townhomes", "", "")),
        (None, ((), "", "", "", "", "")),
        ("", ((), "", "", "", "", "")),
    ],
)
def test_names(text, wanted):
    assert tuple(parse.parse_name(text)) == wanted


def test_agencies():
    a = parse.parse_agency
    assert a("C. of Rundipesturst") == a("RUNDIPESTURST, CITY OF") == a("City ofRundipesturst (RUNCR)") == parse.Agency("city", ("rundipesturst",))
    assert a("A & B Mgmt.") == a("B + A Mgt Company") and a("SkovapasenHousing") == a("Skovapasen Hsg.")
    assert a("various") == a(None) == a("n/a") == parse.Agency("", ())
    assert bodies_agree("X", "") is None and bodies_agree("~city:abcdefgh", "~city:abcdefg") and bodies_agree("X", "Y") is False


def test_words():
    assert words_agree("plalurgosk", "cannery", "plalurgosk", "cannery") == 1.0
    assert words_agree("plalurgosk", "cannery", "plalurgsk", "canery") > 0.8
    assert words_agree("plalurgosk", "cannery", "strandomex", "cannery") == 0.0
    assert words_agree("plalurgosk", "cannery", "plalurgosk", "heron") == 0.0


def test_junk_never_fails():
    rng = random.Random(1)
    pool = "aZ09 ,.;#-–/()&'\n\t​﻿é中🏠|No. Apt CA 95468 St Phase II at the of"
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(60)))
        parse.parse_address(text), parse.parse_name(text), parse.parse_agency(text)
