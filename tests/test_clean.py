"""Cleaning functions on the edge rows of FIXTURES section 4."""

from decimal import Decimal

import datetime as dt
from pyspark.sql import functions as F

from tillstar.functions import clean
from tillstar.functions.calendar import calendar_columns


def one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"v {typ}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def test_money_currency_text(spark):
    assert one(spark, lambda c: clean.round_money(clean.money(c)), "$1,234.50") == Decimal("1234.5000")


def test_not_numeric_is_null(spark):
    for v in ("abc", "", None):
        assert one(spark, clean.money, v) is None
        assert one(spark, clean.guarded_number, v) is None


def test_scientific_lenient_vs_guarded(spark):
    assert one(spark, clean.money, "1e3") == Decimal("1000")
    assert one(spark, clean.guarded_number, "1e3") is None
    assert one(spark, clean.guarded_number, ".5") is None
    assert one(spark, clean.guarded_number, "5.") is None
    assert one(spark, clean.guarded_number, "-5.25") == Decimal("-5.25")


def test_discount_percent_and_passes(spark):
    norm = lambda c: clean.norm_discount(clean.money(c))
    assert one(spark, norm, "20") == Decimal("0.20")
    assert one(spark, norm, "150") == Decimal("1.50")
    twice = lambda c: clean.norm_discount(clean.norm_discount(clean.money(c)))
    assert one(spark, twice, "150") == Decimal("0.02")  # 1.5 -> 0.015 -> half-up 0.02
    clamp = lambda c: clean.norm_discount_clamped(clean.norm_discount(clean.money(c)))
    assert one(spark, clamp, "150") == Decimal("0.02")
    assert one(spark, norm, "-0.1") == Decimal("-0.10")
    assert one(spark, lambda c: clean.norm_discount_clamped(clean.money(c)), "-0.1") == Decimal("0.00")
    assert one(spark, lambda c: clean.norm_discount_clamped(clean.money(c)), None) is None
    assert one(spark, lambda c: clean.fill_discount(clean.money(c)), None) == Decimal("0.00")


def test_dates(spark):
    assert one(spark, clean.parse_date, "1/2/2018") == dt.date(2018, 1, 2)
    assert one(spark, clean.parse_date, "01/02/2018") == dt.date(2018, 1, 2)
    assert one(spark, clean.parse_date, "2016-11-08") == dt.date(2016, 11, 8)
    assert one(spark, clean.parse_date, "zz") is None


def test_dates_equal_trying_each_format(spark):
    texts = [None, "", "zz", "/", "-", "13/1/2018", "2/30/2018", "1/2/18", "1-2-2018", "2016/11/08", "2016-11-8", "0000-01-01",
             " 1/2/2018", "1/2/2018 ", "2016-02-29", "2017-02-29", "-2016-01-01", "12/31/1999-", "1/2-3"]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    tried = F.coalesce(*[F.try_to_date("v", f) for f in clean.DATE_FORMATS])
    assert rows.where(~clean.parse_date(F.col("v")).eqNullSafe(tried)).count() == 0


def test_a_date_format_is_not_tried_on_text_without_its_separator(spark, monkeypatch):
    monkeypatch.setattr(clean.F, "try_to_date", lambda c, f: F.raise_error(F.lit("tried")).cast("date"))
    assert one(spark, clean.parse_date, "zz") is None


def test_quantity_truncates(spark):
    q = lambda c: clean.to_quantity(clean.money(c))
    assert one(spark, q, "2.7") == 2
    assert one(spark, q, "-2.7") == -2
    assert one(spark, q, None) is None


def test_unit_price(spark):
    df = spark.createDataFrame([(Decimal("10.0000"), 3), (Decimal("5"), 0), (None, 2)],
                               "s decimal(12,4), q int")
    got = [r[0] for r in df.select(clean.unit_price(F.col("s"), F.col("q"))).collect()]
    assert got == [Decimal("3.3333"), None, None]


def test_trim_and_weekend(spark):
    assert one(spark, F.trim, " A, B ") == "A, B"
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 6),), (dt.date(2024, 1, 8),)], "d date")
    cols = calendar_columns(F.col("d"))
    got = [(r[0], r[1]) for r in df.select(cols["day_of_week"], cols["is_weekend"]).collect()]
    assert got == [(0, True), (6, True), (1, False)]


def test_row_hash_missing_column_and_stability(spark):
    from helpers import raw_rows

    df = clean.ensure_columns(clean.rename_headers(raw_rows(spark, {}).drop("Postal Code")))
    assert "postal_code" in df.columns
    h1 = df.select(clean.row_hash()).first()[0]
    h2 = df.select(clean.row_hash()).first()[0]
    assert h1 == h2 and len(h1) == 64
    full = clean.ensure_columns(clean.rename_headers(raw_rows(spark, {"Postal Code": ""})))
    assert full.select(clean.row_hash()).first()[0] == h1  # NULL hashes like empty text
