"""Column names, value parsing, ids and lending arithmetic."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanlake.functions import finance
from loanlake.functions.columns import keys_first, normalise_names, select_typed
from loanlake.functions.ids import applicant_id, number_rows, row_key, sequential_id
from loanlake.functions.parse import (
    clean_phone,
    digits_only,
    parse_numbers,
    text_to_number,
    text_to_timestamp,
)


def apply(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r.y for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Applicant Full Name", "applicant_full_name"),
        ("income (usd)", "income_usd"),
        ("LOAN_TYPE", "loan_type"),
        ("Loan Amount USD", "loan_amount_usd"),
        ("  next-of-kin  Name ", "next_of_kin_name"),
    ],
)
def test_standard_names(raw, expected):
    assert normalise_names([raw]) == [expected]


def test_legacy_names_differ_per_source():
    raw = [" Amount (USD) "]
    assert normalise_names(raw, "legacy_applications") == ["amount_usd"]
    assert normalise_names(raw, "legacy_repayments") == ["_amount_usd_"]
    assert normalise_names(raw, "legacy_credit") == ["_amount_(usd)_"]


def test_names_that_clash_are_an_error():
    with pytest.raises(ValueError, match="loan_type"):
        normalise_names(["Loan Type", "loan-type"])


NUMBERS = [
    "1e5", " 12 ", "$5", "1,000", "1d", "1f", "nan", "NaN", "inf", "-inf", "Infinity", "+5",
    "-.5", "5.", "1_000", "0x10", "0x1p3", "1e", "", "12abc", "--1", "1 2", "\t7\n", "INF",
    "None", "1E+3", ".", "+", "true", None, "00012", "1e-3", "- 1",
]


def test_numbers_follow_pandas(spark):
    expected = pd.to_numeric(pd.Series(NUMBERS, dtype=object), errors="coerce")
    got = apply(spark, NUMBERS, text_to_number)
    assert [None if np.isnan(e) else e for e in expected] == got


def test_typed_numbers_lose_nan_only(spark):
    df = spark.createDataFrame([(1.5, 3), (float("nan"), None)], "a double, b int")
    rows = parse_numbers(df, ["a", "b", "absent"]).collect()
    assert [tuple(r) for r in rows] == [(1.5, 3.0), (None, None)]


DATES = [
    "2024-01-15", "2024-2-3", "2024-02", "20240201", "2024/02/01", "02024-01-01", "2024-13-01", "2024-02-30", "", "bad-date", None, "2024-02-29",
]


def test_iso_dates_follow_pandas(spark):
    expected = pd.to_datetime(pd.Series(DATES), format="%Y-%m-%d", errors="coerce")
    got = apply(spark, DATES, text_to_timestamp)
    assert [None if pd.isna(e) else e.to_pydatetime() for e in expected] == got


def test_iso_dates_may_have_a_time_of_day(spark):
    values = [
        "2024-01-05 10:30:00", "2024-01-05T10:30:00", " 2024-01-05", "2024-1-5 9:05", "2024-01-05 25:00",
        "2024-01-05 10:30:00.250", "2024-01-05 ten", "2024-01-05T10:30:00Z",
    ]
    assert apply(spark, values, text_to_timestamp) == [
        dt.datetime(2024, 1, 5, 10, 30), dt.datetime(2024, 1, 5, 10, 30), dt.datetime(2024, 1, 5),
        dt.datetime(2024, 1, 5, 9, 5), None, dt.datetime(2024, 1, 5, 10, 30, 0, 250_000), None, None,
    ]


def test_declared_formats_are_tried_in_order(spark):
    parse = lambda c: text_to_timestamp(c, ["iso", "dd/MM/yyyy", "yyyy-MM-dd HH:mm"])
    values = ["2024-01-15", "15/01/2024", "2024-01-15 10:30", "x"]
    assert apply(spark, values, parse) == [
        dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 15, 10, 30), None,
    ]


def test_phones(spark):
    values = ["+44 7911 123456", "(555) 123-4567", "n/a", None, "+1+2", "٣-4"]
    assert apply(spark, values, clean_phone) == [
        "+447911123456", "5551234567", None, None, "+1+2", "٣4",
    ]
    assert apply(spark, values[:2], digits_only) == ["447911123456", "5551234567"]


def test_applicant_ids(spark):
    got = apply(spark, ["111-22-3333", "444-55-6666", None], applicant_id)
    assert got[0] == "APP-2e54cc08"
    assert got[1].startswith("APP-") and got[1] != got[0]
    assert got[2] == "APP-UNKNOWN"
    assert len(apply(spark, ["x"], lambda c: applicant_id(c, 32))[0]) == 36


def test_row_keys_tell_null_from_empty_and_shifted_values(spark):
    rows = [("a", None), ("a", ""), (None, "a"), ("", "a"), ("a", "b"), ("ab", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    keys = [r.k for r in df.select(row_key(["x", "y"], "Em").alias("k")).collect()]
    assert len(set(keys)) == len(rows)
    assert all(k.startswith("Em") and len(k) == 66 for k in keys)


def test_row_numbers_are_dense_in_total_order(spark):
    values = [(f"{random.Random(i).random():.6f}", i % 7) for i in range(5000)]
    df = spark.createDataFrame([*values, (None, 1)], "a string, b int").repartition(13)
    got = number_rows(df, ["a", "b"], "n").orderBy("n").collect()
    expected = [(None, 1), *sorted(values)]
    assert [(r.a, r.b) for r in got] == expected
    assert [r.n for r in got] == list(range(len(expected)))


def test_sequential_ids_are_not_cut(spark):
    got = apply(spark, [0, 42, 1234567], sequential_id, "bigint")
    assert got == ["APP-000000", "APP-000042", "APP-1234567"]


def payment(spark, rows):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "i int, p double, r double, n double"
    )
    pay = finance.monthly_payment(F.col("p"), F.col("r"), F.col("n"))
    return [r.y for r in df.select("i", pay.alias("y")).orderBy("i").collect()]


def test_monthly_payment(spark):
    rows = [
        (10000.0, 5.5, 36.0), (25000.0, 7.2, 60.0), (10000.0, 0.0, 36.0), (10000.0, -1.0, 36.0),
        (10000.0, None, 36.0), (10000.0, 5.5, None), (None, 5.5, 36.0), (10000.0, 5.5, 0.0),
        (10000.0, 0.0, 0.0), (10000.0, 600.0, 1e6),
    ]
    assert payment(spark, rows) == [
        301.96, 497.39, 277.78, 277.78, 277.78, 191.01, None, None, None, None,
    ]


def test_monthly_payment_against_numpy(spark):
    rng = random.Random(7)
    rows = [
        (float(rng.randint(1, 500000)), rng.choice([0.75 * k for k in range(13)]),
         float(rng.choice([12, 24, 36, 60, 7, 1])))
        for _ in range(3000)
    ]
    p, r, n = (np.array(c) for c in zip(*rows, strict=True))
    r = r / 100 / 12
    with np.errstate(invalid="ignore", divide="ignore"):
        growth = (1 + r) ** n
        expected = np.round(np.where(r > 0, p * (r * growth / (growth - 1)), p / n), 2)
    got = np.array(payment(spark, rows))
    # The last bit of pow may differ between libraries, so a tie may fall either way.
    assert np.abs(got - expected).max() <= 0.01 + 1e-9
    assert (got == expected).mean() > 0.999


def test_rounding_is_half_even(spark):
    got = apply(spark, [0.125, 0.375, 2.675, -0.125], finance.round_cents, "double")
    assert got == [0.12, 0.38, 2.68, -0.12]


def test_credit_bands(spark):
    scores = [299.0, 299.5, 300.0, 579.0, 579.5, 669.0, 669.5, 720.0, 740.0, 800.0, 850.0, 851.0, None]
    assert apply(spark, scores, finance.credit_band, "double") == [
        None, "Poor", "Poor", "Poor", "Fair", "Fair", "Good", "Good", "Very Good", "Exceptional",
        "Exceptional", None, None,
    ]
    assert apply(spark, scores, finance.report_band, "double") == [
        "Poor", "Poor", "Poor", "Poor", "Poor", "Fair", "Excellent", "Good", "Very Good",
        "Excellent", "Excellent", "Excellent", "Excellent",
    ]


def test_segments(spark):
    amounts = [None, 0.0, 1000.0, 1000.5, 5000.0, 5001.0, 10000.0, 10001.0, 50000.0, 50001.0]
    assert apply(spark, amounts, finance.loan_segment, "double") == [
        "MICRO", "MICRO", "MICRO", "SMALL", "SMALL", "SMALL", "SMALL", "MEDIUM", "MEDIUM", "LARGE",
    ]
    assert apply(spark, amounts, finance.value_tier, "double")[:6] == [
        "LOW_VALUE", "LOW_VALUE", "LOW_VALUE", "MEDIUM_VALUE", "MEDIUM_VALUE", "HIGH_VALUE",
    ]


def test_flags(spark):
    assert apply(spark, [None, 0.0, 30.0, 30.5, 35.0], finance.is_delinquent, "double") == [
        False, False, False, True, True,
    ]
    df = spark.createDataFrame(
        [(0, "Good"), (0, None), (1, None), (None, "Poor"), (None, None), (2, "Good")],
        "n int, band string",
    )
    risk = finance.is_high_risk(F.col("n"), F.col("band"))
    assert [r.y for r in df.select(risk.alias("y")).collect()] == [
        False, None, True, True, None, True,
    ]


def test_projections(spark):
    df = spark.createDataFrame([(1, "a")], "x int, k string")
    assert keys_first(df, "k").columns == ["k", "x"]
    row = df.select(*select_typed(df, {"k": "string", "missing": "double"})).first()
    assert (row.k, row.missing) == ("a", None)
