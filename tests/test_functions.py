from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import billing, calendar, cleaning

REF = date(2026, 6, 30)


def one_column(spark, rule, values, kind):
    rows = [(i, value) for i, value in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(rule(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "raw, clean",
    [("  Ana  ", "ana"), ("BETO", "beto"), (None, None), ("", ""), ("\tÉva\n", "éva"), ("　x\xa0", "x"), ("a b", "a b")],
)
def test_clean_text(spark, raw, clean):
    assert one_column(spark, cleaning.clean_text, [raw], "string") == [clean]


def test_clean_text_takes_numbers(spark):
    assert one_column(spark, cleaning.clean_text, [15, None], "int") == ["15", None]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("2024-01-15", date(2024, 1, 15)),
        (" 2024-01-15 ", date(2024, 1, 15)),
        ("not-a-date", None),
        ("2024", None),
        ("", None),
        ("0000-00-00", None),
        ("2024-02-30", None),
        ("2024-01-15 23:30:00", date(2024, 1, 15)),
        ("2024-01-15T23:30:00Z", date(2024, 1, 15)),
        ("2024-01-15T23:30-03:00", date(2024, 1, 16)),
        ("2024-01-15T23:30:00.123-0300", date(2024, 1, 16)),
        ("2024-01-15T00:30:00+03:00", date(2024, 1, 14)),
        (None, None),
    ],
)
def test_clean_date(spark, raw, clean):
    assert one_column(spark, cleaning.clean_date, [raw], "string") == [clean]


def test_clean_date_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        values = ["2024-01-15T23:30-03:00", "2024-01-15 23:30:00", "2024-01-15"]
        days = one_column(spark, cleaning.clean_date, values, "string")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert days == [date(2024, 1, 16), date(2024, 1, 15), date(2024, 1, 15)]


@pytest.mark.parametrize(
    "raw, clean",
    [("10.5", 10.5), ("20", 20.0), ("abc", None), ("1d", None), ("nan", None), ("1,5", None), ("", None), (" 7 ", 7.0),
     ("1e3", 1000.0), ("-.5", -0.5), (None, None)],
)
def test_clean_number(spark, raw, clean):
    assert one_column(spark, cleaning.clean_number, [raw], "string") == [clean]


def test_clean_number_to_integer(spark):
    values = one_column(spark, lambda c: cleaning.clean_number(c, "bigint"), ["2010", "2.5", "x", "1e30"], "string")
    assert values == [2010, 2, None, None]


def test_lists(spark):
    lists = [["15607", "15608"], ["15607"], [], None, ["a", None]]
    assert one_column(spark, cleaning.first_of_list, [[""], ["joao"], [], None], "array<string>") == ["", "joao", None, None]
    assert one_column(spark, cleaning.join_list, lists, "array<string>") == ["15607,15608", "15607", "", None, "a,None"]
    assert one_column(spark, lambda c: cleaning.join_list(c, "|"), lists[:1], "array<string>") == ["15607|15608"]
    assert one_column(spark, cleaning.first_of_json, ['["joao"]', "joao", "[]", None], "string") == ["joao", "joao", None, None]
    assert one_column(spark, cleaning.split_list, ["a,,b,", "", None], "string") == [["a", "", "b", ""], [""], None]
    assert one_column(spark, lambda c: cleaning.split_list(c, "|"), ["a|b"], "string") == [["a", "b"]]


def test_field_of_each(spark):
    kind = "array<struct<codigo_cooperativa: string, x: int>>"
    values = one_column(spark, lambda c: cleaning.field_of_each(c, "codigo_cooperativa"), [[("1", 1), ("2", 2)], [], None], kind)
    assert values == [["1", "2"], [], None]


def test_to_flag(spark):
    words = ["Y", "N", "SIM", "NÃO", "sim", "y", None]
    flags = one_column(spark, lambda c: cleaning.to_flag(c, {"y", "s", "sim"}), words, "string")
    assert flags == [True, False, True, False, True, True, None]


def test_days_overdue_and_buckets(spark):
    days = one_column(spark, lambda c: billing.days_overdue(c, REF), [date(2026, 6, 1), date(2026, 7, 1), None], "date")
    assert days == [29, 0, None]
    buckets = one_column(spark, billing.aging_bucket, [0, 30, 31, 60, 61, 90, 91, None], "bigint")
    assert buckets == ["0-30", "0-30", "31-60", "31-60", "61-90", "61-90", "90+", None]


@pytest.mark.parametrize(
    "flag, billed, paid, status",
    [
        ("n", 100.0, 0.0, "nao_pago"),
        ("y", 100.0, 100.0, "pago_integral"),
        ("y", 100.0, 80.0, "pago_a_menor"),
        ("y", 100.0, 120.0, "pago_a_maior"),
        ("y", 100.0, None, "pago_a_maior"),
        (None, 100.0, 100.0, "nao_pago"),
        ("y", 1.12, 1.13, "pago_integral"),
    ],
)
def test_payment_status(spark, flag, billed, paid, status):
    df = spark.createDataFrame([(flag, billed, paid)], "f string, b double, p double")
    assert df.select(billing.payment_status(F.col("f"), F.col("b"), F.col("p"))).first()[0] == status


def test_payment_difference(spark):
    df = spark.createDataFrame([(100.0, 80.0), (None, 1.0)], "b double, p double")
    assert [r[0] for r in df.select(billing.payment_difference(F.col("b"), F.col("p"))).collect()] == [-20.0, None]


@pytest.mark.parametrize(
    "birth, reference, years",
    [
        (date(2000, 12, 1), REF, 25),
        (date(2000, 1, 15), REF, 26),
        (date(2000, 6, 30), REF, 26),
        (None, REF, None),
        (date(2000, 2, 29), date(2023, 2, 28), 22),
        (date(2000, 2, 29), date(2023, 3, 1), 23),
        (date(2030, 1, 1), REF, -4),
    ],
)
def test_age_years(spark, birth, reference, years):
    assert one_column(spark, lambda c: billing.age_years(c, reference), [birth], "date") == [years]


def test_share_of_nothing_is_null(spark):
    df = spark.createDataFrame([(9.0, 3), (9.0, 0), (9.0, None)], "v double, n bigint")
    assert [r[0] for r in df.select(billing.share(F.col("v"), F.col("n"))).collect()] == [3.0, None, None]


def test_month_ranges(spark):
    rows = calendar.month_ranges(spark, date(2019, 11, 5), date(2020, 2, 3)).orderBy("first_day").collect()
    assert [tuple(r) for r in rows] == [
        (date(2019, 11, 1), date(2019, 11, 30)),
        (date(2019, 12, 1), date(2019, 12, 31)),
        (date(2020, 1, 1), date(2020, 1, 31)),
        (date(2020, 2, 1), date(2020, 2, 29)),
    ]


def test_times(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 2, 1, 30, 0),), (None,)], "t timestamp")
    day, time = calendar.local_day_and_time(F.col("t"))
    hours = calendar.hours_since(F.col("t"), datetime(2026, 1, 2, 13, 0, 0))
    assert [tuple(r) for r in df.select(day, time, hours).collect()] == [("01/01/2026", "22:30:00", 11.5), (None, None, None)]
