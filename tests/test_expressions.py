import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollbook.functions import text as X
from rollbook.functions.times import iso_second, iso_text, run_start


def one(spark, expr, *values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_address_keys(spark):
    got = one(
        spark, X.address_key, "100 Oak Street, San Jose, CA 95112", "100 Oak St San Jose CA 95112", "1701 W El Camino Real, Mountain View, CA 94040", "San Jose, CA", "5 Ave", None, ""
    )
    assert got == ["100oakst", "100oakstsanjoseca95112", "1701welcaminoreal", "sanjoseca", "5ave", "", ""]


def test_name_keys(spark):
    got = one(spark, X.name_key, "Oak Creek Apartments", "The Park Gardens", "Parkside Village Family Apartments", "Courtyard at Park Plaza", "Gardens", " apartments", None, "José Gardens")
    assert got == ["oakcreek", "the", "parkside", "courtyardat", "gardens", "", "", "jos"]


def name_key_plain(s):
    s = s.lower()
    for x in X.NAME_SUFFIXES:
        s = s[: -len(x)] if s.endswith(x) else s.replace(x, " ")
    return "".join(c for c in s if c.isascii() and c.isalnum())


def test_name_keys_equal_plain_rule(spark):
    words = ["oak", "park", "senior", "family", "apartments", "apartment", "housing", "homes", "village", "court", "way", "drive", "lofts", "plaza", "the"]

    @settings(max_examples=20, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(words), max_size=7).map(" ".join), min_size=1, max_size=20))
    def check(names):
        assert one(spark, X.name_key, *names) == [name_key_plain(n) for n in names]

    check()


def test_authority_labels(spark):
    got = one(spark, X.authority_label, " John Stewart Company (SCCHA) ", "SCCHA", "Eah", "MidPen portfolio", "  City of X\t", None)
    assert got == ["John Stewart Company", "Santa Clara County Housing Authority", "EAH Housing", "MidPen Housing", "City of X", ""]


def test_csv_safe(spark):
    assert one(spark, X.csv_safe, "=1+1", "+1", "-x", "@a", "\tx", "fine", None, "") == ["'=1+1", "'+1", "'-x", "'@a", "'\tx", "fine", "", ""]


def test_urls(spark):
    good = ["https://a.example/x", "http://a.example", " https://a.example "]
    bad = ["ftp://a.example", "http://localhost/x", "http://10.0.0.1/", "https://u:p@a.example/", "http://192.168.1.1", "http://x.internal/", "", None, "file:///etc", "http://169.254.1.1", "http://172.16.0.9/"]
    assert one(spark, X.url_allowed, *good) == [True] * len(good)
    assert not any(one(spark, X.url_allowed, *bad))
    assert one(spark, X.unwrapped_url, "https://v.example/view?url=https%3A%2F%2Fa.example%2Ff.pdf", "https://a.example/f.pdf") == ["https://a.example/f.pdf"] * 2


def test_dates_and_times(spark):
    assert [str(x) for x in one(spark, X.iso_date, "since 2025-02-03 or so", "2025-02-30", "", None)] == ["2025-02-03", "None", "None", "None"]
    same = one(spark, lambda c: iso_text(iso_second(c)), "2025-01-02T03:04:05", " 2025-01-02 03:04:05Z", "2025-01-02T03:04:05.999", "2025-01-02T03:04:05+00:00", "junk", "", None)
    assert same == ["2025-01-02T03:04:05"] * 4 + [None] * 3
    assert one(spark, lambda c: iso_text(run_start(c)), "20250102T030405", "x", None) == ["2025-01-02T03:04:05", None, None]


@pytest.mark.parametrize(
    "expr,value,wanted",
    [
        (lambda c: X.clean_text(c, 5), " a\x07b \n c  d ", "ab c"),
        (lambda c: X.slug(c, 10), "Oak & Elm Homes", "oak-elm-ho"),
        (X.name_from_slug, "https://a.example/DocumentCenter/View/oak-creek-60-ami", "Oak Creek (60% AMI)"),
        (X.header_field, "Telephone No.", "phone"),
        (lambda c: X.contact_line(F.lit(""), c, "phone:"), "a | Phone: 555 | email: x", "555"),
        (lambda c: X.clipped(c, 3), "abcdef", "abc..."),
        (X.masked, "secret", "se****et"),
        (lambda c: F.array_join(X.measures(c), "+"), " CDN, eden ,cdn,,eden", "civicplus+eden"),
    ],
)
def test_small_rules(spark, expr, value, wanted):
    assert one(spark, expr, value) == [wanted]
