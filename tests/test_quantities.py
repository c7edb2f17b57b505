import pytest

from tidemark.operators.quantities import read_amounts, solve, to_common_unit

YEAR = {"year": 1, "month": 12, "fortnight": 26, "week": 52, "day": 260, "hour": 1976}
CASES = [
    ("$181,052 — $212,896 plus 15.4% super", "", (181052, 212896)), ("94.23 an hour to 101.90 an hour", "", (186198, 201354)), ("$5,647–$7,003 p/f", "", (146822, 182078)),
    ("169 709 — 206 972 + superannuation of 15.4%", "", (169709, 206972)), ("180.45 k - 196.1k", "", (180450, 196100)), ("51–52.9 k annually", "", (51000, 52900)),
    ("$137.95k-$155,100", "", (137950, 155100)), ("$53.44 per hour - $118,529 per annum", "", (105597, 118529)), ("$56.21-$49.79 /hr [36.75h/wk]", "", (95149, 107417)),
    ("$74.66 - $83.91 an hour based on a 36.75 hour week", "", (142675, 160352)), ("125 315 - 153 357 /yr (APS5)", "", (125315, 153357)), ("$2,072.61 - $2,344.63", "Remuneration here is a weekly figure.", (107776, 121921)),
    ("$4180", "x\nAMOUNTS  SHOWN ARE FOR EACH FORTNIGHT\ny", (108680, 108680)), ("$4180", "Please allow two weeks for the report.", (4180, 4180)), ("USD 83,665 - 89,665 per year", "", None), ("EUR 105,080", "", None),
    ("Negotiable", "", None), ("APS Level 5", "", None), ("", "", None), (None, "", None), ("$0", "", None), ("$128.6 to $140k", "", (128600, 140000)), ("Hourly rate $43.01 — $53.52", "", (84988, 105756)),
]


def test_column(spark):
    df = spark.createDataFrame([(i, s, d) for i, (s, d, _) in enumerate(CASES)], "pay_id int, salary string, description string")
    got = {r["pay_id"]: r["pay"] for r in to_common_unit(df, "salary", "description", YEAR).collect()}
    for i, (salary, _, want) in enumerate(CASES):
        low, high = (got[i]["low"], got[i]["high"]) if got[i] else (None, None)
        assert (low, high) == (want or (None, None)), salary
    assert to_common_unit(df.limit(0), "salary", "description", YEAR).count() == 0
    assert to_common_unit(df.unionAll(df), "salary", "description", YEAR).count() == 2 * len(CASES)


def test_half_up_is_exact():
    assert solve([(5_000, False, "year")], None, None, None, YEAR, 0.05)[0] == 1
    assert solve([(4_999, False, "year")], None, None, None, YEAR, 0.05)[0] == 0


def test_open_case_is_flagged():
    # 30 may stand for 30 or 30,000 beside 1k: both lie as far from it
    amounts = [(30 * 10_000, False, None), (10_000 * 949 // 1000, True, None)]
    found = solve(amounts, None, None, None, YEAR, 0.05)
    assert found[4] is False


@pytest.mark.parametrize(("text", "want"), [
    ("$80,000 - $85,000 - $90,000", (80000, 90000)), ("$95,000 - $99,000 or $80,000 - $85,000", (80000, 99000)), ("$80k - $85 - $90k", (80000, 90000)), ("$80,000 - $85,000, room 7", (80000, 85000)),
])
def test_more_than_two_amounts_give_least_and_greatest(text, want):
    assert solve(*read_amounts(text)[:2], None, None, YEAR, 0.05)[:2] == want


def test_many_amounts_are_flagged():
    assert solve(*read_amounts(" - ".join(f"${n},000" for n in range(80, 120)))[:2], None, None, YEAR, 0.05)[:5:4] == (80000, False)


def test_missing_unit_table_gives_nothing():
    assert solve(read_amounts("$5 a day")[0], None, None, None, {}, 0.05) is None


@pytest.mark.parametrize("text", ["9" * 5000, "$" * 5000, " " * 5000])
def test_long_texts(text):
    read_amounts(text)


def test_the_identity_decides_where_no_unit_is_printed():
    units = {"hour": 1950, "day": 260, "week": 52, "fortnight": 26, "month": 12, "year": 1}
    one = lambda x, unit=None: [(int(x * 10_000), False, unit)]
    for pay, unit in ((45, "hour"), (1_730, "week"), (3_450, "fortnight"), (7_500, "month"), (91_000, "year")):
        low, high, found, residual, unique = solve(one(pay), None, None, None, units, 0.05, expected=90_000, assumed=None)
        assert (low, high, found, unique) == (pay * units[unit], pay * units[unit], unit, True) and residual < 0.1
    # weekly hours change what an hour is worth
    assert solve(one(60), None, None, 300_000, units, 0.05, expected=93_600, assumed=None)[:3] == (93_600, 93_600, "hour")
    # without anything to go by every unit is as good, which is flagged
    assert solve(one(45), None, None, None, units, 0.05, assumed=None)[4] is False
    # two units that come close to what is expected are flagged
    assert solve(one(100), None, None, None, {"week": 52, "month": 50}, 0.05, expected=5_100, assumed=None)[4] is False
    # a printed unit stays, but is flagged where it is far from what is expected
    assert solve(one(85_000, "hour"), None, None, None, units, 0.05, expected=90_000)[2:5:2] == ("hour", False)
    assert solve(one(10**14, "hour"), None, None, None, units, 0.05, expected=90_000)[4] is False
    # the year is assumed unless the ends say otherwise, and one end may have another unit than the other
    assert solve(one(85_000), None, None, None, units, 0.05)[2:5:2] == ("year", True)
    assert solve(one(87_750) + one(46.5, "hour"), None, None, None, units, 0.05)[:2] == (87_750, 90_675)
    assert solve(one(1_000) + one(5_000, "month"), None, None, None, units, 0.05)[:2] == (12_000, 60_000)


def test_expected_pay_as_a_column(spark):
    rows = [(1, "$45", 90_000.0), (2, "$45", None), (3, "$1,730 - $1,800", 90_000.0), (4, None, 1.0), (5, "", -1.0), (6, "$45", float("nan"))]
    df = spark.createDataFrame([(i, t, e, "") for i, t, e in rows], "id int, t string, e double, d string")
    units = {"hour": 1950, "week": 52, "year": 1}
    got = {r["id"]: (r["pay"]["low"], r["pay"]["high"], r["pay"]["is_unique"]) for r in to_common_unit(df, "t", "d", units, expected="e", assumed=None).collect()}
    assert got[1] == (87_750, 87_750, True) and got[2][2] is False and got[3] == (89_960, 93_600, True) and got[4] == got[5] == (None, None, None) and got[6][2] is False
