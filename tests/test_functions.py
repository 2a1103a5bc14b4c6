import pytest
from pyspark.sql import Row, functions as F

from deedmill.functions import calendar, cleaning, deals, parties, scoring, truth
from tests.conftest import values


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def column(spark, rows, kind):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")


@pytest.mark.parametrize(
    "kind, rows, expected",
    [
        ("string", [None, "", "N", "0", "Y", "  "], [False, False, True, True, True, True]),
        ("int", [None, 0, 1, -1], [False, False, True, True]),
        ("double", [None, 0.0, 0.5], [False, False, True]),
        ("boolean", [None, True, False], [False, True, False]),
        ("array<int>", [None, [], [0]], [False, False, True]),
    ],
)
def test_truthy_by_type(spark, kind, rows, expected):
    df = column(spark, rows, kind)
    got = [r[0] for r in df.orderBy("i").select(truth.truthy(df, "v")).collect()]
    assert got == expected


def test_yes_flag_reads_no_texts(spark):
    df = column(spark, [None, "", "N", " n ", "0", "false", "Y", "1"], "string")
    got = [r[0] for r in df.orderBy("i").select(truth.flag(F.col("v"), "yn")).collect()]
    assert got == [False] * 6 + [True, True]
    with pytest.raises(ValueError):
        truth.flag(F.lit("Y"), "other")


NAMES = [None, "", "  ", "acme llc", " ACME LLC\t", "　 Straße\x1c\n", "a  b "]


def test_normalize_name_strips_like_python(spark):
    df = column(spark, NAMES, "string")
    got = [r[0] for r in df.orderBy("i").select(parties.normalize_name(F.col("v"))).collect()]
    assert got == [None if n is None else n.upper().strip() for n in NAMES]


def test_white_space_is_pythons():
    every = {chr(c) for c in range(0x110000) if chr(c).isspace()}
    assert set(parties.WHITE_SPACE) == every


@pytest.mark.parametrize(
    "code, first, last, expected",
    [
        ("C", None, None, "CORPORATION"),
        ("CORP", None, None, "CORPORATION"),
        ("CORPORATION", "A", "B", "CORPORATION"),
        ("T", None, None, "TRUST"),
        ("TRUST", None, None, "TRUST"),
        ("L", None, None, "LLC"),
        ("LLC", None, None, "LLC"),
        ("P", None, None, "PARTNERSHIP"),
        ("PARTNERSHIP", None, None, "PARTNERSHIP"),
        ("c", None, None, "UNKNOWN"),
        (None, "A", "B", "INDIVIDUAL"),
        (None, "A", "", "UNKNOWN"),
        (None, None, "B", "UNKNOWN"),
        (None, None, None, "UNKNOWN"),
    ],
)
def test_classify_entity(spark, code, first, last, expected):
    text = lambda v: F.lit(v).cast("string")
    assert one(spark, parties.classify_entity(text(code), text(first), text(last))) == expected


@pytest.mark.parametrize(
    "arms, amount, expected",
    [
        ("A", 100, "SALE"),
        ("A", 0, "MORTGAGE"),
        (None, 0, "MORTGAGE"),
        (None, 100, "OTHER"),
        ("", 100, "OTHER"),
        ("A", -5, "OTHER"),
        ("A", None, "OTHER"),
    ],
)
def test_classify_transaction(spark, arms, amount, expected):
    arms, amount = F.lit(arms).cast("string"), F.lit(amount).cast("decimal(18,2)")
    assert one(spark, deals.classify_transaction(arms, amount)) == expected
    assert one(spark, deals.is_sale(arms, amount)) == (expected == "SALE")


# ---- months ------------------------------------------------------------------


@pytest.mark.parametrize(
    "month, first, last",
    [
        ("2024-01", "2024-01-01", "2024-01-31"),
        ("2024-02", "2024-02-01", "2024-02-29"),
        ("2023-02", "2023-02-01", "2023-02-28"),
        ("2024-12", "2024-12-01", "2024-12-31"),
    ],
)
def test_month_bounds(spark, month, first, last):
    assert str(one(spark, calendar.month_start(F.lit(month)))) == first
    assert str(one(spark, calendar.month_end(F.lit(month)))) == last


@pytest.mark.parametrize(
    "start, end, expected",
    [
        ("2024-06", "2024-06", ["2024-06"]),
        ("2024-01", "2024-03", ["2024-01", "2024-02", "2024-03"]),
        ("2023-11", "2024-02", ["2023-11", "2023-12", "2024-01", "2024-02"]),
        ("2024-01", "2024-12", [f"2024-{m:02d}" for m in range(1, 13)]),
        ("2024-03", "2024-01", []),
    ],
)
def test_month_series(spark, start, end, expected):
    assert [r["month"] for r in calendar.month_series(spark, start, end).collect()] == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01", True), ("2024-12", True), ("1999-06", True), ("2024-13", False), ("2024-00", False),
        ("2024/01", False), ("January 2024", False), ("not-a-date", False), ("2024-1", False),
        ("2024-01\n", False), ("0000-01", False), ("", False), (None, False),
    ],
)
def test_valid_month(spark, text, expected):
    assert one(spark, calendar.valid_month(F.lit(text).cast("string"))) is expected


def test_default_window(spark):
    first, last = calendar.default_window(as_of="2024-03-01")
    assert str(one(spark, first)) == "2024-02-29" and str(one(spark, last)) == "2024-03-01"
    first, last = calendar.default_window("2024-01-05", "2024-01-09")
    assert str(one(spark, first)) == "2024-01-05" and str(one(spark, last)) == "2024-01-09"


# ---- cleaning and scoring ----------------------------------------------------


def test_cleaning(spark):
    assert one(spark, cleaning.clean_number(F.lit(" 1,250 rooms"))) == 1250.0
    assert one(spark, cleaning.clean_number(F.lit("n/a"))) is None
    for text, number in {"2 full 1 half": 2, "3/4": 3, "-1.5%": -1.5, "1,2,3": 1, "12,345,678.9": 12345678.9, ".5": 0.5}.items():
        assert one(spark, cleaning.clean_number(F.lit(text))) == number
    assert one(spark, cleaning.clean_int(F.lit("9007199254740993"))) == 9007199254740993
    assert one(spark, cleaning.clean_int(F.lit("9" * 30))) is None
    assert one(spark, cleaning.clean_int(F.lit("1998.0"))) == 1998
    assert one(spark, cleaning.truncate_decimals(F.lit("48201.0"))) == "48201"
    assert one(spark, cleaning.truncate_decimals(F.lit("48201"))) == "48201"
    assert str(one(spark, cleaning.clean_date(F.lit("2024-02-29T00:00:00")))) == "2024-02-29"
    assert one(spark, cleaning.clean_date(F.lit("soon"))) is None
    assert one(spark, cleaning.derived_property_id(F.lit("P1"), F.lit("77001"))) == "P1 77001"
    assert float(one(spark, cleaning.dollars_from_millions(F.lit("12.5")))) == 12_500_000.0


@pytest.mark.parametrize(
    "passed, total, threshold, status, text",
    [
        (100, 100, 100, "PASS", "100.0%"),
        (85, 100, 100, "WARN", "85.0%"),
        (84, 100, 100, "FAIL", "84.0%"),
        (80, 100, 95, "WARN", "80.0%"),
        (79, 100, 95, "FAIL", "79.0%"),
        (0, 0, 100, "FAIL", "0.0%"),
        (49, 400, 100, "FAIL", "12.2%"),
    ],
)
def test_score(spark, passed, total, threshold, status, text):
    pct = scoring.percent(F.lit(passed), F.lit(total))
    assert one(spark, scoring.status(pct, F.lit(threshold))) == status
    assert one(spark, scoring.percent_text(pct)) == text


def test_percent_text_rounds_like_python(spark):
    df = spark.range(0, 1001).select(scoring.percent(F.col("id"), F.lit(800)).alias("p"))
    for pct, text in values(df.withColumn("t", scoring.percent_text(F.col("p"))), "p", "t"):
        assert text == f"{pct:.1f}%"


def test_name_fingerprint(spark):
    same = ["Acme Holdings, LLC", "LLC ACME  holdings", "acme-holdings llc llc"]
    df = spark.createDataFrame([Row(n=n) for n in same])
    assert df.select(parties.name_fingerprint(F.col("n"))).distinct().count() == 1
