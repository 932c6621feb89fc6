"""Valuing the harmonised lines: sell-in panel, then sell-out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.operators import pricing


def price_inputs(harmonised: DataFrame) -> DataFrame:
    """Harmonised columns under the names the pricing operators use."""
    return harmonised.withColumns(
        {
            "sellout_dm": F.col("master_code"),
            "fx_transaction_lc": F.col("sales_local_currency"),
        }
    )


def flag_producers(lines: DataFrame) -> DataFrame:
    return lines.withColumn(
        "is_no_media",
        pricing.anomaly_flag(F.col("fx_transaction_lc"), F.col("quantity"), F.col("sellout_dm")),
    )


def valued_sellin(lines: DataFrame, allow_future: bool = False) -> DataFrame:
    """Sell-in lines of ``split_panel(with_price_columns(...))`` with prices and amounts.

    A usable line prices its own key, so it ends without a price only if a part of the key
    is missing. The markups therefore come straight from the flagged lines, and the priced
    lines need not be computed twice or stored in between.
    """
    flagged = flag_producers(lines.filter(F.col("panel_segment") == "sellin_producer"))
    priced = pricing.price_producers(flagged, allow_future=allow_future)
    dealers = lines.filter(F.col("panel_segment") == "sellin_dealer")
    complete = flagged.dropna(subset=list(pricing.PRICE_KEYS))
    markups = pricing.markup(pricing.retail_price(lines), complete)
    return pricing.valorize(priced, dealers, markups)


def valorise_panel(
    df: DataFrame, consolidation: DataFrame | None = None, allow_future: bool = False
) -> DataFrame:
    """Panel table: valued and period-split sell-in plus sell-out lines still to be valued.

    Lines that belong to no panel are passed through with their ``panel_segment``, so a
    count per segment accounts for every input row.
    """
    lines = pricing.split_panel(pricing.with_price_columns(df))
    sellin = pricing.overlap(valued_sellin(lines, allow_future), consolidation)
    split = pricing.split_periods(sellin)
    waiting = lines.filter(F.col("panel_segment").isin("sellout", "unrouted")).withColumn(
        "_original_period", pricing.original_period(F.col("date"))
    )
    return split.unionByName(waiting, allowMissingColumns=True).drop(
        "_year", "_semester", "_dest_key"
    )


def valorise_sellout(panel: DataFrame, consolidation: DataFrame | None = None) -> DataFrame:
    """Value the sell-out lines of a panel table against its sell-in prices."""
    waiting = panel.filter(F.col("panel_segment") == "sellout")
    valued = panel.filter(F.col("is_no_media").isNotNull())
    return pricing.overlap(pricing.valorize_sellout(waiting, valued), consolidation)
