import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from tradeloom.functions import dates, events, masking, text
from tradeloom.functions.companies import canonical_company


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        (" company_045 ", "COMPANY_GROUP_002"),
        ("Company_070", "COMPANY_GROUP_001"),
        ("acme", "ACME"),
        (None, None),
    ],
)
def test_canonical_company(spark, raw, expected):
    assert one(spark, canonical_company(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("05/04/2024", datetime.date(2024, 4, 5)),  # day first
        ("05/14/2024", datetime.date(2024, 5, 14)),
        ("2024-02-03T10:11:12", datetime.date(2024, 2, 3)),
        ("2024-02-03 10:11:12.123", datetime.date(2024, 2, 3)),
        ("3-4-2024", datetime.date(2024, 4, 3)),
        ("soon", None),
    ],
)
def test_dates_are_tried_in_order_and_never_raise(spark, raw, expected):
    assert one(spark, dates.parse_date(F.lit(raw))) == expected


def test_named_months_need_the_longer_list(spark):
    layouts = (*dates.DATE_FORMATS, *dates.NAMED_MONTH_FORMATS)
    assert one(spark, dates.parse_date(F.lit("Jan 5 2024"), layouts)) == datetime.date(2024, 1, 5)


def test_period_labels(spark):
    found = spark.range(1).select(
        dates.month_number(F.lit("M07")), dates.quarter_month(F.lit("q3")),
        dates.half_month(F.lit("H2")), dates.year_number(F.lit("FY2024")),
        dates.period_start(F.lit(2026), F.lit("q4")), dates.period_start(F.lit(2026), F.lit("13")),
        dates.period_type(F.lit("h1")),
    ).first()
    assert tuple(found) == (7, 7, 7, 2024, datetime.date(2026, 10, 1), None, "semi-annual")


def test_submission_number(spark):
    stamp = F.lit("2025-07-01 12:34:56.789").cast("timestamp")
    assert one(spark, dates.submission_number(stamp)) == 20250701123456789


@pytest.mark.parametrize(
    ("sales", "quantity", "volumes", "expected"),
    [
        (None, None, None, "empty"), (0.0, 0.0, None, "empty"), (1.0, 1.0, None, "commercial_sale"),
        (-1.0, -1.0, None, "return"), (-1.0, None, None, "rebate"), (0.0, 2.0, None, "freebie"),
        (1.0, 0.0, 5.0, "service"), (1.0, None, 5.0, "commercial_sale"),
        (1.0, -1.0, None, "accounting_adjustment"), (-1.0, 1.0, None, "accounting_adjustment"),
        (None, -1.0, None, "anomaly"),
    ],
)
def test_event_types(spark, sales, quantity, volumes, expected):
    values = [F.lit(v).cast("double") for v in (sales, quantity, volumes)]
    assert one(spark, events.classify_event(*values)) == expected


def test_text_cleaning(spark):
    found = spark.range(1).select(
        text.trailing_code(F.lit("NAME (270 432) ")), text.trailing_code(F.lit("NAME")),
        text.without_trailing_code(F.lit("BIG   NAME (270432)")),
        text.clean_identifier(F.lit("12.0")), text.clean_identifier(F.lit(" ")),
        text.strip_letter_suffix(F.lit("AB12CD")),
        text.display_name(F.lit(" ESPAÑA"), {"espana": "Spain"}),
        text.decimal_text(F.lit(" 1,25 ")), text.decimal_text(F.lit("abc")),
        text.squeeze_spaces(F.lit(" a \n b ")), text.leading_digits(F.lit("x1")),
    ).first()
    assert tuple(found) == (
        "270432", "_", "BIG NAME", "12", None, "AB12", "Spain", 1.25, None, "a b", None,
    )


def test_mask_is_stable_and_keeps_null(spark):
    digest = hashlib.sha256(b"Rossi").hexdigest()[-10:]
    assert one(spark, masking.mask_customer(F.lit("Rossi"))) == f"CUSTOMER_{digest}"
    assert one(spark, masking.mask_customer(F.lit("Rossi"), privileged=True)) == "Rossi"
    assert one(spark, masking.mask_customer(F.lit(None).cast("string"))) is None


def test_mask_is_callable_from_sql(spark):
    masking.register_mask_function(spark)
    row = spark.sql("select mask_customer('Rossi') as a, mask_customer(null) as b").first()
    assert row["a"] == one(spark, masking.mask_customer(F.lit("Rossi"))) and row["b"] is None
    masking.register_mask_function(spark, privileged_when="current_user() is not null")
    assert spark.sql("select mask_customer('Rossi') as a").first()["a"] == "Rossi"
