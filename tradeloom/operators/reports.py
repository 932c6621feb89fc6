"""Reshaping of report sheets held as a cell grid.

Cells are ``file_id, file_name, row_idx, col_idx, text, num``: one row per cell of any
number of files. A decoder outside this package produces them.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeloom.functions import dates, text
from tradeloom.operators.joins import measured
from tradeloom.operators.running import last_seen, running
from tradeloom.session import cut_lineage

# The row walkers below travel with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Month column heads of the monthly sheets, January first.
MONTH_COLUMNS = ("gen", "feb", "mar", "apr", "mag", "giu", "lug", "ago", "set", "ott", "nov", "dic")
# Account group labels and the channel they stand for.
ACCOUNT_GROUP_CHANNELS = {
    "00 Domestic Trade Sales": "direct_sales",
    "02 Export Trade Sales": "distribution",
}
# Channel tokens in file names.
FILE_CHANNELS = {"distributor": "distributor", "directsales": "direct_sales"}
COUNTRY_OVERRIDES = {"espana": "Spain"}  # fixed value
# Labels and patterns of the sheets.
TOTAL_WORD = "total"
OVERALL = "Overall Result"
EXCLUDED_CODES = ("Result", "Overall Result", "~ROOT", "")
HIERARCHY_CODE = r"^(\d{2}){1,6}$"
SCENARIO_LABEL = r"^(ACT|BUD|PLAN)\s?\d{2}$"
THOUSANDS_UNIT = r"1[\s ]?000"
PLACEHOLDER_ROW = r"(?i)^MARCA\s*\d+\s*\(rellenar con nombre de la marca\)$"
SALES_METRIC, QUANTITY_METRIC = "Gross Sales", "Quantity"
HEADER_ROWS = 5

# ------------------------------------------------------------------------- plain sheets


def cells_to_rows(cells: DataFrame, columns: Sequence[str], header_row: int = 0) -> DataFrame:
    """Named rows below a header row; heads are trimmed and lower-cased.

    ``columns`` fixes the output, so no pass over the data is needed to discover it; an
    absent head gives a NULL column.
    """
    heads = (
        cells.filter(F.col("row_idx") == header_row)
        .groupBy("file_id", "col_idx")
        .agg(F.min(F.lower(F.trim("text"))).alias("head"))
        .filter(F.col("head").isin(*columns))
    )
    body = cells.filter(F.col("row_idx") > header_row)
    named = body.join(heads, ["file_id", "col_idx"])
    return named.groupBy("file_id", "row_idx").agg(
        *[F.max(F.when(F.col("head") == name, F.col("text"))).alias(name) for name in columns]
    )


def drop_total_rows(df: DataFrame, columns: Sequence[str], word: str = TOTAL_WORD) -> DataFrame:
    """Remove rows that mention a total in any of ``columns``."""
    return df.filter(~text.mentions_word([F.col(c) for c in columns], word))


def unpivot_months(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per non-zero month: ``keep`` columns, ``month`` and ``value``.

    Month columns hold text with decimal commas; ``-``, blanks and absent months are zero.
    """
    months = []
    for number, name in enumerate(MONTH_COLUMNS, 1):
        if name in df.columns:
            value = text.decimal_text(F.col(name))
            month = F.struct(F.lit(number).alias("month"), value.alias("value"))
            months.append(F.when(value != 0, month))
    # Empty months leave the array before rows are multiplied.
    return df.select(*keep, F.inline(F.array_compact(F.array(*months))))


def filename_metadata(name: Column) -> dict[str, Column]:
    """Columns read from names like ``acme_italy_distributor_2026_q1.xlsx``."""
    stem = F.regexp_replace(F.lower(name), r"\.[a-z0-9]+$", "")
    pattern = (
        r"^([a-z]+(?:_\d+)?)_([a-z]+)_(?:(distributor|directsales)_)?(20\d{2}|19\d{2})_"
        r"(q[1-4]|h[12]|\d{2})$"
    )

    def group(index: int) -> Column:
        return F.nullif(F.regexp_extract(stem, pattern, index), F.lit(""))

    channels = F.create_map(*[F.lit(p) for pair in FILE_CHANNELS.items() for p in pair])
    year, period = group(4).cast("int"), group(5)
    return {
        "company": F.initcap(group(1)),
        "country": F.initcap(group(2)),
        "channel": F.try_element_at(channels, F.coalesce(group(3), F.lit(""))),
        "year": year,
        "period": period,
        "period_type": dates.period_type(period),
        "date": dates.period_start(year, period),
    }


def dataset_metadata(name: Column) -> dict[str, Column]:
    """Dataset key, metric, panel flag and year of a paired quantity / value file."""
    lowered = F.lower(name)
    stem = F.regexp_replace(lowered, r"(?:\.xlsx?|\.xlsb)+$", "")
    return {
        "dataset_key": F.regexp_replace(stem, r"_(quantity|value|sales)(?=_|$)", ""),
        "metric_type": F.when(lowered.contains("quantity"), "quantity").when(
            lowered.contains("sales") | lowered.contains("value"), "gross_sales"
        ),
        "is_panel": F.when(lowered.rlike("no_?panel"), False).when(
            lowered.contains("market"), True
        ),
        "year": F.nullif(F.regexp_extract(lowered, r"((?:19|20)\d{2})", 1), F.lit("")).cast("int"),
    }


def merge_metric_files(
    lines: DataFrame, keys: Sequence[str] = ("dataset_key", "date", "item_code")
) -> DataFrame:
    """Quantities and values of a dataset side by side, whichever file has the key.

    ``lines`` holds both files in long form (``metric_type``, ``value``, descriptive
    columns, ``file_name``). One grouped pass replaces a full outer join, so a frequent
    key is combined before the shuffle and repeated keys add up instead of multiplying.
    Descriptions come from the quantity file when it has the key. A file whose name tells
    no known metric fails the merge: its amounts would be lost.
    """
    unknown = F.raise_error(F.concat(F.lit("Unknown metric of file "), F.coalesce("file_name", F.lit("?"))))
    lines = lines.withColumn("metric_type", F.coalesce("metric_type", unknown.cast("string")))
    is_quantity = F.col("metric_type") == "quantity"
    described = [
        c for c in lines.columns if c not in (*keys, "metric_type", "value", "file_name")
    ]

    def measure(wanted: Column) -> Column:
        return F.coalesce(F.sum(F.when(wanted, F.col("value"))), F.lit(0.0))

    def prefer_quantity(name: str) -> Column:
        return F.coalesce(
            F.min(F.when(is_quantity, F.col(name))), F.min(F.when(~is_quantity, F.col(name)))
        ).alias(name)

    quantity_file = F.min(F.when(is_quantity, F.col("file_name")))
    value_file = F.min(F.when(~is_quantity, F.col("file_name")))
    return lines.groupBy(*keys).agg(
        *[prefer_quantity(name) for name in described],
        measure(is_quantity).alias("quantity"),
        F.round(measure(~is_quantity), 2).alias("gross_sales"),
        F.array_join(
            F.array_distinct(F.array_compact(F.array(quantity_file, value_file))), " | "
        ).alias("file_name"),
    )


def key_coverage(
    lines: DataFrame, keys: Sequence[str] = ("dataset_key", "date", "item_code")
) -> DataFrame:
    """Keys present in only one of the two metric files."""
    is_quantity = F.col("metric_type") == "quantity"
    return (
        lines.groupBy(*keys)
        .agg(
            F.max(is_quantity).alias("_in_quantity"),
            F.max(~is_quantity).alias("_in_value"),
        )
        .filter(F.col("_in_quantity") != F.col("_in_value"))
        .select(
            *keys,
            F.when(F.col("_in_quantity"), "gross_sales").otherwise("quantity").alias("missing_in"),
        )
    )


# -------------------------------------------------------------------------- flat exports


# Columns of the transactional export that pass through as they are.
CARRIED_CODES = (
    "sales_organization", "sales_office", "business_unit", "line_of_business", "pac1", "pac23",
    "country_code",
)
# Amounts of the transactional export, each with a ``_currency`` column.
EXPORT_AMOUNTS = ("gross_sales", "sales_packet", "gross_avg_price", "packet_avg_price")


def flat_report_a(df: DataFrame, company: str) -> DataFrame:
    """Transactional export with coded text fields: one output row per line, all landing columns.

    Amounts that are no numbers become NULL, quantities 0. The month is ``MM.YYYY``; truncated values fall back to the year and month numbers.
    """
    dotted = F.try_to_date(F.concat(F.lit("01."), F.col("month_text")), "dd.MM.yyyy")
    year, month = F.col("year_no").try_cast("int"), F.col("month_no").try_cast("int")
    fallback = F.when(month.between(1, 12), F.make_date(year, month, F.lit(1)))
    channels = F.create_map(*[F.lit(p) for pair in ACCOUNT_GROUP_CHANNELS.items() for p in pair])

    def amount(name: str) -> Column:
        return F.round(F.col(name).try_cast("double"), 2)

    return df.select(
        F.coalesce(F.when(F.col("month_text").rlike(r"^\d{2}\.\d{4}$"), dotted), fallback).alias(
            "date"
        ),
        F.lit(company).alias("company"),
        F.initcap(F.trim("country")).alias("country"),
        F.try_element_at(channels, F.col("account_group")).alias("channel"),
        text.first_token(F.col("material")).alias("item_code"),
        text.after_first_token(F.col("material")).alias("item_description"),
        F.array(F.trim("key_product"), F.trim("product_planning")).alias("item_categories"),
        text.leading_digits(F.col("sold_to")).alias("customer_code"),
        text.after_leading_digits(F.col("sold_to")).alias("customer"),
        F.col("account_group").alias("customer_account_assignment_group"),
        *CARRIED_CODES,
        *[column for name in EXPORT_AMOUNTS for column in (amount(name).alias(name), F.col(f"{name}_currency"))],
        F.coalesce(F.col("quantity").try_cast("double"), F.lit(0.0)).cast("int").alias("quantity"),
        F.col("quantity_uom"),
        F.col("file_name"),
    )


# Landing column of the delivery export -> its column in the file.
DELIVERY_TEXTS = {
    "product_family_level_1": "descripcion",
    "brand_company": "marca",
    "item_description": "producto",
    "customer_raw": "cliente",
    "locality": "localida",
    "province": "provincia",
    "price_list": "tarifa",
}
DELIVERY_CODES = {
    "manufacturer_item_code": "codfabricante",
    "postal_code": "postal_code",
    "province_code": "codprovincia",
    "country_code": "codpais",
    "series": "serie",
    "document_number": "document",
    "product_line": "linea",
}


def flat_report_b(df: DataFrame, company: str) -> DataFrame:
    """Delivery export with unit prices and charges: one output row per line, all landing columns.

    Customer match, channel and data matrix are for later steps to fill and start as NULL.
    ``sheet_row`` counts data rows from zero; sheet rows start at 2 below the heads.
    """
    row_id = (F.col("sheet_row") + 2).cast("int")
    stem = F.regexp_replace(F.col("file_name"), r"\.[^.]+$", "")
    first_three = F.array_join(F.slice(F.split(F.trim("fecha"), r"\s+"), 1, 3), " ")
    country = text.display_name(F.col("nombre"), COUNTRY_OVERRIDES)
    item = text.clean_identifier(F.col("item"))

    def number(name: str) -> Column:
        return F.coalesce(F.col(name).try_cast("double"), F.lit(0.0))

    quantity, charge = number("unidades"), number("cargo")
    gross = F.round(quantity * number("precio"), 2)
    return df.select(
        dates.parse_date(first_three, (*dates.DATE_FORMATS, *dates.NAMED_MONTH_FORMATS)).alias(
            "date"
        ),
        row_id.alias("source_row_id"),
        F.concat_ws("|", stem, row_id.cast("string")).alias("source_key"),
        F.concat(F.lit(f"{company}|"), item).alias("company_item_code"),
        F.lit(company).alias("company"),
        item.alias("item_code"),
        *[text.squeeze_spaces(F.col(raw)).alias(name) for name, raw in DELIVERY_TEXTS.items()],
        *[text.clean_identifier(F.col(raw)).alias(name) for name, raw in DELIVERY_CODES.items()],
        *[F.lit(None).cast("string").alias(name) for name in ("clean_customer", "channel_raw", "data_matrix")],
        country.alias("country_raw"),
        country.alias("destination_country_raw"),
        gross.alias("gross_sales"),
        charge.alias("sales_charge"),
        (gross * (1.0 + charge)).alias("gross_sales_with_charges"),
        F.lit("month").alias("time_frames"),
        F.lit(None).cast("double").alias("volumes"),
        quantity.alias("quantity"),
        F.lit("sell-out").alias("data_collection"),
        F.lit("sell-out").alias("project"),
        F.col("file_name"),
    )


# -------------------------------------------------------------------- family / brand sheets

SEGMENT_ROWS = 20_000  # row numbers of one part of a long segment; parts are walked apart
_TOTAL_TOLERANCE = 1e-9
_BRAND_SCHEMA = (
    "file_id string, row_idx long, family string, subfamily string, brand string, quantity double"
)
_PART_SCHEMA = (
    "file_id string, segment long, part long, total double, "
    "limits array<double>, rests array<double>, heads array<string>"
)
_ENTRY_SCHEMA = "file_id string, segment long, part long, rest double, head string"


def _wanted(total: float) -> float:
    """What brands must add up to before the next head; a head without a total waits for its segment's end."""
    return float("inf") if pd.isna(total) else total - _TOTAL_TOLERANCE * max(1.0, abs(total))


def _part_outcome(labels: list[str | None], values: list[float]) -> tuple[float, list, list, list]:
    """What one part of a segment makes of any state that enters it: its total and limits, rests and heads.

    The state is the rest that brands still owe to the open head. A head opens after the first row whose running
    sum reaches the rest, and from there on all is settled, so an entering rest matters only by the running
    maximum that it is met by: ``limits`` are those maxima, ``rests`` and ``heads`` the state that leaves the
    part for each. A rest above all limits leaves less ``total``.
    """
    wanted = [_wanted(v) for v in values]
    sums = list(accumulate(0.0 if pd.isna(v) else v for v in values))
    n, end = len(sums), sums[-1]
    leaving: list[tuple[float, str | None]] = [(0.0, None)] * n
    # Rows that lift the running maximum of what follows, the nearest and lowest at the end of the list.
    at: list[int] = []
    negated: list[float] = []
    for row in range(n - 1, -1, -1):
        while negated and -negated[-1] <= sums[row]:
            negated.pop()
            at.pop()
        negated.append(-sums[row])
        at.append(row)
        found = bisect_right(negated, -(sums[row] + wanted[row])) - 1
        met = at[found] if found >= 0 else n - 1
        leaving[row] = leaving[met + 1] if met < n - 1 else (wanted[row] - (end - sums[row]), labels[row])
    limits: list[float] = []
    outcomes: list[tuple[float, str | None]] = []
    for row, reached in enumerate([0.0, *sums[:-1]]):
        if limits and reached <= limits[-1]:
            continue
        if outcomes and outcomes[-1] == leaving[row]:
            limits[-1] = reached  # chains of heads soon meet, which keeps this list short
        else:
            limits.append(reached)
            outcomes.append(leaving[row])
    return end, limits, [rest for rest, _ in outcomes], [head for _, head in outcomes]


def _part_outcomes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per part, from rows sorted by file, segment, part and row; one part is held at a time."""
    names = ["file_id", "segment", "part", "total", "limits", "rests", "heads"]
    place, labels, values = None, [], []
    for batch in batches:
        done = []
        for *own, label, value in zip(*[batch[c] for c in ("file_id", "segment", "part", "label", "value")]):
            if own != place:
                if place is not None:
                    done.append((*place, *_part_outcome(labels, values)))
                place, labels, values = own, [], []
            labels.append(label)
            values.append(value)
        yield pd.DataFrame(done, columns=names)
    if place is not None:
        yield pd.DataFrame([(*place, *_part_outcome(labels, values))], columns=names)


def _entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The state that enters each part, from outcomes sorted by file, segment and part."""
    segment, rest, head = None, 0.0, None
    for batch in batches:
        found = []
        for file_id, number, part, total, limits, rests, heads in batch.itertuples(index=False):
            if (file_id, number) != segment:
                segment, rest, head = (file_id, number), float("-inf"), None
            found.append((file_id, number, part, rest, head))
            met = bisect_left(limits, rest)
            rest, head = (rests[met], heads[met]) if met < len(limits) else (rest - total, head)
        yield pd.DataFrame(found, columns=["file_id", "segment", "part", "rest", "head"])


def _brand_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tell subfamily heads from brand rows in rows sorted by file, segment, part and row.

    State is one open subfamily, carried across batches, so memory stays constant. A part without an entry row
    is a whole segment.
    """
    place, subfamily, rest = None, None, 0.0
    for batch in batches:
        found = []
        rows = zip(
            batch["file_id"], batch["segment"], batch["part"], batch["is_row"], batch["row_idx"],
            batch["family"], batch["label"], batch["value"],
        )
        for file_id, number, part, is_row, row_idx, family, label, value in rows:
            if not is_row:
                place, subfamily, rest = (file_id, number, part), label, value
                continue
            if (file_id, number, part) != place or rest <= 0:
                place, subfamily, rest = (file_id, number, part), label, _wanted(value)
            elif not pd.isna(value):
                found.append((file_id, row_idx, family, subfamily, label, value))
                rest -= value
        yield pd.DataFrame(
            found, columns=["file_id", "row_idx", "family", "subfamily", "brand", "quantity"]
        )


def block_segments(rows: DataFrame, part_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Brand rows of family / subfamily / brand sheets, with their family and subfamily.

    ``rows``: ``file_id, row_idx, familia, label, value``. A placeholder row or a filled
    family always opens a new block, which splits a sheet into independent segments found
    with running sums. Inside a segment the next head follows once the brands add up to the
    total of the current one. Segments of more than ``part_rows`` rows are walked in parallel, in
    parts of as many row numbers: each part is first reduced to its outcome for any state, the states that
    enter the parts follow from these few rows, then every part is walked on its own.
    Figures are finite; a row without one is no brand, and a head without one lasts to the segment's end.
    """
    label = F.trim("label")
    placeholder = F.coalesce(label.rlike(PLACEHOLDER_ROW), F.lit(False))
    opens = placeholder | F.col("familia").isNotNull()
    marked = rows.select(
        F.col("file_id").cast("string").alias("file_id"),
        F.col("row_idx").cast("long").alias("row_idx"),
        label.alias("label"),
        F.col("value").cast("double").alias("value"),
        F.trim("familia").alias("familia"),
        placeholder.alias("placeholder"),
        opens.cast("long").alias("opens"),
    )
    named = ~F.col("placeholder") & F.col("familia").isNotNull()
    carried = running(
        marked,
        ["file_id"],
        "row_idx",
        sums={"segment": F.col("opens")},
        maxima={"seen": last_seen("row_idx", named, F.col("familia"))},
    )
    lines = cut_lineage(
        carried.filter(~F.col("placeholder")).select(
            "file_id",
            F.col("segment").cast("long").alias("segment"),
            "row_idx",
            F.col("seen.value").alias("family"),
            "label",
            "value",
        )
    )
    whole = ["file_id", "segment"]
    long = lines.groupBy(*whole).agg(F.count("*").alias("n")).filter(F.col("n") > part_rows)
    long = measured(long.select(*whole, F.lit(True).alias("is_long")))
    parts = lines.join(long, whole, "left").withColumn(
        "part", F.when(F.col("is_long"), F.floor(F.col("row_idx") / part_rows)).cast("long")
    )
    outcomes = (
        parts.filter("is_long")
        .select(*whole, "part", "label", "value", "row_idx")
        .repartition(*whole, "part")
        .sortWithinPartitions(*whole, "part", "row_idx")
        .mapInPandas(_part_outcomes, _PART_SCHEMA)
    )
    entries = (
        outcomes.repartition(*whole)
        .sortWithinPartitions(*whole, "part")
        .mapInPandas(_entries, _ENTRY_SCHEMA)
        .select(
            *whole,
            "part",
            F.lit(False).alias("is_row"),
            F.lit(None).cast("long").alias("row_idx"),
            F.lit(None).cast("string").alias("family"),
            F.col("head").alias("label"),
            F.col("rest").alias("value"),
        )
    )
    return (
        parts.drop("is_long")
        .withColumns({"is_row": F.lit(True), "part": F.coalesce("part", F.lit(0))})
        .unionByName(entries)
        .repartition(*whole, "part")
        .sortWithinPartitions(*whole, "part", "is_row", "row_idx")
        .mapInPandas(_brand_rows, _BRAND_SCHEMA)
    )


def sheet_countries(cells: DataFrame) -> DataFrame:
    """``file_id, country`` of family sheets: their first cell of the second row, by its known name or in title case."""
    named = F.max(F.when((F.col("row_idx") == 1) & (F.col("col_idx") == 0), F.col("text")))
    titles = cells.groupBy("file_id").agg(named.alias("title"))
    return titles.select("file_id", text.display_name(F.col("title"), COUNTRY_OVERRIDES).alias("country"))


def brand_landing(brands: DataFrame, files: DataFrame) -> DataFrame:
    """Landing rows of the brand rows of family sheets (see :func:`block_segments`).

    ``files``: ``file_id, file_name, country`` of each file, the country from its sheet. Company, period and date
    come from the file's name; a file whose name tells none fails the import.
    """
    meta = filename_metadata(F.col("file_name"))
    refused = F.raise_error(F.concat(F.lit("No period in the file name "), F.coalesce("file_name", F.lit(""))))
    files = files.select(
        F.col("file_id").cast("string").alias("file_id"),
        F.coalesce(meta["date"], refused.cast("date")).alias("date"),
        meta["company"].alias("company"),
        "country",
        meta["period_type"].alias("period_type"),
        "file_name",
    )
    return brands.join(files, "file_id").select(
        "date",
        "company",
        "country",
        F.col("brand").alias("item_description"),
        F.array("family", "subfamily").alias("item_categories"),
        "quantity",
        "period_type",
        "file_name",
        "row_idx",
    )


# --------------------------------------------------------------------- spanned header grid

_GRID_SCHEMA = "file_id string, row_idx long, col_idx long, text string, num double"


def _band_grid(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Place the cells of rows sorted by file, band, row and cell.

    ``spans`` maps a column to the last row, label and number of the cell covering it.
    """
    band, row, column, spans = None, None, 0, {}

    def inherit() -> list[tuple]:
        """Cells from earlier rows that cover the columns from ``column`` on."""
        nonlocal column
        taken = []
        while column in spans and spans[column][0] >= row:
            taken.append((band[0], row, column, *spans[column][1:]))
            column += 1
        return taken

    for batch in batches:
        placed = []
        cells = zip(
            batch["file_id"], batch["band"], batch["row_idx"],
            batch["colspan"], batch["rowspan"], batch["text"], batch["num"],
        )
        for file_id, number, row_idx, colspan, rowspan, label, num in cells:
            if (file_id, number, row_idx) != (*(band or (None, None)), row):
                if row is not None:
                    placed += inherit()
                if (file_id, number) != band:
                    band, spans = (file_id, number), {}
                row, column = row_idx, 0
            placed += inherit()
            for at in range(column, column + colspan):
                placed.append((file_id, row, at, label, num))
                if rowspan > 1:
                    spans[at] = (row + rowspan - 1, label, num)
            column += colspan
        yield pd.DataFrame(placed, columns=["file_id", "row_idx", "col_idx", "text", "num"])
    if row is not None:
        yield pd.DataFrame(inherit(), columns=["file_id", "row_idx", "col_idx", "text", "num"])


def span_expand(cells: DataFrame) -> DataFrame:
    """Grid positions of cells that span columns and rows.

    ``cells``: ``file_id, row_idx, cell_idx, colspan, rowspan, text, num``. Rows no earlier
    span reaches into start a new band. A band of one row needs only a running sum of column
    spans; only bands tied together by row spans (headers) are walked in Python.
    """
    wide = cells.select(
        F.col("file_id").cast("string").alias("file_id"),
        F.col("row_idx").cast("long").alias("row_idx"),
        F.col("cell_idx").cast("long").alias("cell_idx"),
        # A span that is missing, 0 or negative covers one column or row.
        F.greatest(F.coalesce("colspan", F.lit(1)), F.lit(1)).cast("long").alias("colspan"),
        F.greatest(F.coalesce("rowspan", F.lit(1)), F.lit(1)).cast("long").alias("rowspan"),
        "text",
        F.col("num").cast("double").alias("num"),
    )
    # One row per sheet row: far fewer than cells, and read several times below.
    rows = cut_lineage(
        wide.groupBy("file_id", "row_idx").agg(
            (F.col("row_idx") + F.max("rowspan") - 1).alias("reach")
        )
    )
    reached = running(
        rows, ["file_id"], "row_idx", maxima={"reached": F.col("reach")}, inclusive=False
    )
    starts = F.coalesce(F.col("reached") < F.col("row_idx"), F.lit(True))
    banded = cut_lineage(
        running(
            reached, ["file_id"], "row_idx", maxima={"band": F.when(starts, F.col("row_idx"))}
        ).select(
            "file_id",
            "row_idx",
            "band",
            (starts & (F.col("reach") == F.col("row_idx"))).alias("is_alone"),
        )
    )
    before = (
        W.partitionBy("file_id", "row_idx")
        .orderBy("cell_idx")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    alone = (
        wide.join(banded.filter("is_alone"), ["file_id", "row_idx"])
        .withColumn("first", F.coalesce(F.sum("colspan").over(before), F.lit(0)))
        .select(
            "file_id",
            "row_idx",
            F.explode(F.sequence(F.col("first"), F.col("first") + F.col("colspan") - 1)).alias("col_idx"),
            "text",
            "num",
        )
    )
    walked = (
        wide.join(banded.filter("not is_alone"), ["file_id", "row_idx"])
        .select("file_id", "band", "row_idx", "cell_idx", "colspan", "rowspan", "text", "num")
        .repartition("file_id", "band")
        .sortWithinPartitions("file_id", "band", "row_idx", "cell_idx")
        .mapInPandas(_band_grid, _GRID_SCHEMA)
    )
    return alone.unionByName(walked)


# ------------------------------------------------------------------------ matrix exports


def header_roles(cells: DataFrame) -> DataFrame:
    """Rows of the scenario, partner code and partner name heads, per file.

    Among header rows 1-3 the first mostly made of scenario labels is the scenario row; of
    the other two the more numeric one holds the codes.
    """
    label = F.col("text")
    filled = label.isNotNull() & (label != "")
    named = filled & ~label.isin("Partner", OVERALL)
    rows = (
        cells.filter(F.col("row_idx").between(1, HEADER_ROWS - 2))
        .groupBy("file_id", "row_idx")
        .agg(
            F.coalesce(
                F.avg(F.when(filled, label.rlike(SCENARIO_LABEL).cast("double"))), F.lit(0.0)
            ).alias("scenario_part"),
            F.coalesce(
                F.avg(F.when(named, label.rlike(r"^\d+$").cast("double"))), F.lit(0.0)
            ).alias("numeric_part"),
        )
    )
    scenario = F.min(F.when(F.col("scenario_part") > 0.5, F.col("row_idx")))
    per_file = rows.groupBy("file_id").agg(
        scenario.alias("scenario_row"),
        *[F.max(F.when(F.col("row_idx") == i, F.col("numeric_part"))).alias(f"_part{i}") for i in (1, 2, 3)],
    )

    def part(i: int) -> Column:
        return F.struct(F.col(f"_part{i}").alias("part"), F.lit(-i).alias("rank"))

    code = F.greatest(
        *[F.when(F.col("scenario_row") != i, part(i)) for i in (1, 2, 3)]
    )
    missing = F.raise_error(F.concat(F.lit("No scenario row in file "), F.col("file_id").cast("string")))
    found = F.coalesce(F.col("scenario_row").cast("long"), missing.cast("long"))
    # A file without any cell in the header rows has no scenario row either.
    per_file = cells.select("file_id").distinct().join(per_file, "file_id", "left")
    return per_file.withColumn("code_row", (-code["rank"]).cast("long")).select(
        "file_id",
        found.alias("scenario_row"),
        "code_row",
        (6 - F.col("scenario_row") - F.col("code_row")).cast("long").alias("name_row"),
    )


def hierarchy_leaves(rows: DataFrame, levels: int = 6) -> DataFrame:
    """Product rows with their category path.

    ``rows``: ``file_id, row_idx, code, description``. Codes of digit pairs are category
    heads whose depth is the number of pairs; a head closes the deeper ones before it.
    """
    code = F.col("code")
    level = F.when(code.rlike(HIERARCHY_CODE), F.length(code) / 2)
    heads = {
        f"head{n}": last_seen("row_idx", level == n, F.col("description"))
        for n in range(1, levels + 1)
    }
    carried = running(rows, ["file_id"], "row_idx", maxima=heads)
    path = []
    for n in range(1, levels + 1):
        own = F.col(f"head{n}.at")
        shallower = [F.col(f"head{k}.at") for k in range(1, n)]
        still_open = F.lit(True)
        for position in shallower:
            still_open = still_open & F.coalesce(position < own, F.lit(True))
        path.append(F.when(still_open, F.col(f"head{n}.value")))
    leaf = level.isNull() & code.isNotNull() & ~code.isin(*EXCLUDED_CODES)
    return carried.filter(leaf).select(
        *rows.columns, F.array_compact(F.array(*path)).alias("item_categories")
    )


def matrix_to_long(cells: DataFrame, leaves: DataFrame, roles: DataFrame) -> DataFrame:
    """One row per product row and partner with its sales and quantity.

    Header cells are looked up by file and column; the overall column is skipped, partners
    without sales are not listed, and a pair with neither figure gives no row.
    """
    head = cells.filter(F.col("row_idx") < HEADER_ROWS).join(roles, "file_id")

    def at(row: Column | int) -> Column:
        return F.max(F.when(F.col("row_idx") == row, F.col("text")))

    columns = (
        head.filter(F.col("col_idx") >= 4)
        .groupBy("file_id", "col_idx")
        .agg(
            at(0).alias("metric"),
            at(F.col("code_row")).alias("partner_id"),
            at(F.col("name_row")).alias("partner_name"),
            F.when(at(4).rlike(THOUSANDS_UNIT), 1000.0).otherwise(1.0).alias("scale"),
        )
        .filter(
            F.col("metric").isin(SALES_METRIC, QUANTITY_METRIC)
            & (F.col("partner_id") != "")
            & (F.col("partner_id") != OVERALL)
        )
    )
    selling = (
        columns.filter((F.col("metric") == SALES_METRIC) & (F.col("partner_name") != OVERALL))
        .groupBy("file_id", "partner_id")
        .agg(F.min_by("partner_name", "col_idx").alias("customer_raw"))
    )
    # A partner listed twice for a metric keeps its last column.
    partners = (
        columns.groupBy("file_id", "partner_id", "metric")
        .agg(F.max(F.struct("col_idx", "scale")).alias("last"))
        .select("file_id", "partner_id", "metric", "last.col_idx", "last.scale")
        .join(selling, ["file_id", "partner_id"])
    )
    figures = (
        cells.filter((F.col("row_idx") >= HEADER_ROWS) & F.col("num").isNotNull())
        .join(partners, ["file_id", "col_idx"])
        .groupBy("file_id", "row_idx", "partner_id", "customer_raw")
        .agg(
            *[
                F.max(F.when(F.col("metric") == metric, F.col("num") * F.col("scale"))).alias(name)
                for metric, name in ((SALES_METRIC, "gross_sales"), (QUANTITY_METRIC, "quantity"))
            ]
        )
    )
    return leaves.join(figures, ["file_id", "row_idx"]).select(
        *leaves.columns,
        text.strip_letter_suffix(F.col("code")).alias("item_code"),
        "partner_id",
        "customer_raw",
        F.coalesce("gross_sales", F.lit(0.0)).alias("gross_sales"),
        F.coalesce("quantity", F.lit(0.0)).alias("quantity"),
    )


MATRIX_CURRENCY = "EUR"  # fixed value


def matrix_landing(long: DataFrame, files: DataFrame, brand: str) -> DataFrame:
    """Landing rows of product and partner figures (see :func:`matrix_to_long`), all landing columns.

    ``long`` also has ``month_text``, the month's number of each product row; ``files``: ``file_id, file_name``. Company,
    destination country, channel and year come from the file's name, ``brand`` is the maker that all its products
    have; a row without a date fails the import.
    Customer match, country and data matrix are for later steps to fill and start as NULL.
    """
    meta = filename_metadata(F.col("file_name"))
    files = files.select(
        "file_id",
        "file_name",
        F.regexp_replace("file_name", r"\.[^.]+$", "").alias("stem"),
        *[meta[name].alias(name) for name in ("company", "country", "channel", "year")],
    )
    month = F.trim("month_text").try_cast("int")
    date = F.when(month.between(1, 12), F.make_date("year", month, F.lit(1)))
    refused = F.raise_error(
        F.concat(F.lit("No date in row "), F.col("row_idx"), F.lit(" of "), F.coalesce("file_name", F.lit("")))
    )
    nothing = F.lit(None).cast("string")
    return long.join(files, "file_id").select(
        F.coalesce(date, refused.cast("date")).alias("date"),
        F.col("row_idx").alias("source_row_id"),
        F.concat_ws("|", "stem", "channel", F.col("row_idx").cast("string"), "partner_id").alias("source_key"),
        F.concat_ws("|", "company", "item_code").alias("company_item_code"),
        "company",
        F.trim("description").alias("item_description"),
        F.lit(brand).alias("brand_company"),
        "item_code",
        F.col("channel").alias("channel_raw"),
        "customer_raw",
        nothing.alias("clean_customer"),
        nothing.alias("country_raw"),
        F.col("country").alias("destination_country_raw"),
        F.lit(MATRIX_CURRENCY).alias("gross_sales_currency"),
        F.lit("month").alias("time_frames"),
        F.lit(None).cast("double").alias("volumes"),
        "quantity",
        "gross_sales",
        nothing.alias("data_matrix"),
        F.lit("sell-out").alias("data_collection"),
        F.lit("sell-out").alias("project"),
        "file_name",
    )
