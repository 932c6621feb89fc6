"""Curated sell-out rows and the KPI marts built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeloom.functions.dates import month_start, semester
from tradeloom.operators.joins import lookup_join, measured
from tradeloom.operators.lookup import require_columns


def latest_version(df: DataFrame, keys: Sequence[Column], version: str) -> DataFrame:
    """Rows that carry the highest ``version`` of their key; NULL is a key like any other.

    The highest versions come from a partial aggregate, not from a window: a key with a
    third of all rows never meets in one task. While the keys are few enough to broadcast
    the rows themselves are not shuffled at all.
    """
    named = {f"_key{i}": key for i, key in enumerate(keys)}
    newest = (
        df.groupBy(*[value.alias(name) for name, value in named.items()])
        .agg(F.max(version).alias("_newest"))
        .filter(F.col("_newest").isNotNull())
    )
    tagged = lookup_join(df, measured(newest), named, ["_newest"], null_safe=True)
    return tagged.filter(F.col(version) == F.col("_newest")).drop("_newest")


def latest_submission(df: DataFrame) -> DataFrame:
    """Rows of the newest submission of each company and reporting month."""
    require_columns(df, {"date", "company", "submission_id"})
    return latest_version(df, [F.col("company"), month_start(F.col("date"))], "submission_id")


def curate(df: DataFrame) -> DataFrame:
    """Publishable rows: newest submissions with period columns and a unit price."""
    date = F.col("date")
    curated = latest_submission(df).withColumns(
        {
            "reporting_month": month_start(date),
            "year": F.year(date),
            "month": F.month(date),
            "semester": semester(date),
            "gold_loaded_at": F.current_timestamp(),
        }
    )
    if {"sales_local_currency", "quantity"} <= set(curated.columns):
        unit = F.round(F.try_divide("sales_local_currency", "quantity"), 2)
        curated = curated.withColumn("sales_per_unit", F.when(F.col("quantity") > 0, unit))
    return curated


def _columns(df: DataFrame) -> tuple[str, Column]:
    """Sales column and currency expression the table offers."""
    require_columns(df, {"reporting_month", "year", "semester", "company", "quantity"})
    sales = next((c for c in ("sales_local_currency", "sales") if c in df.columns), None)
    if sales is None:
        raise ValueError("KPIs need sales_local_currency or sales")
    currency = next((c for c in ("local_currency", "billing_currency") if c in df.columns), None)
    return sales, F.col(currency) if currency else F.lit("N/A")


def _distinct(df: DataFrame, column: str) -> Column:
    return F.countDistinct(column) if column in df.columns else F.lit(0).cast("long")


def _or_na(df: DataFrame, column: str) -> Column:
    return F.col(column) if column in df.columns else F.lit("N/A")


def company_kpi(df: DataFrame) -> DataFrame:
    """Monthly company KPIs with the change against the previous month on record."""
    sales, currency = _columns(df)
    monthly = df.groupBy(
        "reporting_month", "year", "semester", "company", currency.alias("currency")
    ).agg(
        F.sum("quantity").alias("total_quantity"),
        F.sum(sales).alias("total_sales"),
        _distinct(df, "item_code").alias("active_products"),
        _distinct(df, "destination_country").alias("active_markets"),
        _distinct(df, "customer").alias("active_customers"),
    )
    in_order = W.partitionBy("company", "currency").orderBy("reporting_month")
    previous = F.col("previous_month_sales")
    growth = F.round((F.col("total_sales") / F.nullif(previous, F.lit(0.0)) - 1) * 100, 2)
    return monthly.withColumn(
        "previous_month_sales", F.lag("total_sales").over(in_order)
    ).withColumns(
        {
            "sales_delta_vs_previous_month": F.col("total_sales") - previous,
            "sales_growth_pct": growth,
        }
    )


def product_kpi(df: DataFrame) -> DataFrame:
    """Semester KPIs per product."""
    require_columns(df, {"item_code"})
    sales, currency = _columns(df)
    return df.groupBy("year", "semester", "item_code", currency.alias("currency")).agg(
        F.sum("quantity").alias("total_quantity"),
        F.sum(sales).alias("total_sales"),
        F.round(F.try_divide(F.sum(sales), F.sum("quantity")), 2).alias("avg_sales_per_unit"),
        _distinct(df, "destination_country").alias("markets_reached"),
        _distinct(df, "customer").alias("active_customers"),
    )


def market_kpi(df: DataFrame) -> DataFrame:
    """Monthly KPIs per destination country and channel."""
    sales, currency = _columns(df)
    return df.groupBy(
        "reporting_month",
        "year",
        "semester",
        _or_na(df, "destination_country").alias("destination_country"),
        _or_na(df, "channel").alias("channel"),
        currency.alias("currency"),
    ).agg(
        F.sum("quantity").alias("total_quantity"),
        F.sum(sales).alias("total_sales"),
        F.countDistinct("company").alias("active_companies"),
        _distinct(df, "item_code").alias("active_products"),
        _distinct(df, "customer").alias("active_customers"),
    )
