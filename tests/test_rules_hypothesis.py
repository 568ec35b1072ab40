"""Property tests of the numeric and text rules against plain-Python references."""

import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from bizlens.functions.numeric import ratio_round
from bizlens.functions.text import parse_measure

PAIRS = st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(-10**6, 10**6)), min_size=1, max_size=60)


def _expected(n, d, digits, mult):
    if d == 0:
        return None
    q = (Decimal(n) * mult / Decimal(d)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)
    return float(q)


@settings(max_examples=15, deadline=None)
@given(PAIRS, st.sampled_from([0, 1, 2]), st.sampled_from([1, 100]))
def test_ratio_round_is_exact_half_away_from_zero(spark, pairs, digits, mult):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(ratio_round("n", "d", digits, mult)).collect()]
    assert got == [_expected(n, d, digits, mult) for n, d in pairs]


TEXTS = st.lists(st.one_of(
    st.none(), st.sampled_from(["", "null", " ", "km", "-", "."]),
    st.builds(lambda x, u: f"{x}{u}", st.decimals(0, 1000, places=1).map(str),
              st.sampled_from(["", "km", " km", "mins", " minutes", " minute"]))), min_size=1, max_size=40)


def _leading_number(t):
    if t is None:
        return None
    m = re.match(r"^\s*([+-]?[0-9]*\.?[0-9]+)", t)
    return float(m.group(1)) if m else None


@settings(max_examples=15, deadline=None)
@given(TEXTS)
def test_parse_measure_takes_the_leading_number(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_measure("t")).collect()]
    assert got == [_leading_number(t) for t in texts]


DATES = st.lists(st.dates(min_value=__import__("datetime").date(1900, 1, 1),
                          max_value=__import__("datetime").date(2100, 12, 31)), min_size=1, max_size=60)


@settings(max_examples=15, deadline=None)
@given(DATES)
def test_calendar_rules_match_python(spark, days):
    from bizlens.functions.calendar import day_name, iso_yearweek, month_name, seven_day_week, sunday_week
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(sunday_week("d"), iso_yearweek("d"), day_name("d"), month_name("d"), seven_day_week("d")).collect()
    for d, r in zip(days, got):
        iso = d.isocalendar()
        assert tuple(r) == (int(d.strftime("%U")), iso[0] * 100 + iso[1], d.strftime("%A"), d.strftime("%B"),
                            (d.timetuple().tm_yday + 6) // 7)
