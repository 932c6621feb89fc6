"""Mapping-driven import of report tables with unknown column names."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions import dates
from tradeloom.functions.companies import canonical_company, company_from_landing_name
from tradeloom.operators.lookup import pick_column

# Type names of mapping tables and the column types they mean.
MAPPING_TYPES = {
    "VARCHAR": "string",
    "STRING": "string",
    "TEXT": "string",
    "INTEGER": "int",
    "INT": "int",
    "BIGINT": "long",
    "DOUBLE": "double",
    "FLOAT": "double",
    "DECIMAL": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
    "BOOLEAN": "boolean",
}
# Targets that describe the period and end up in ``date``.
PERIOD_TARGETS = ("date", "year", "month", "semester", "quarter")
# Output of the fixed-template import, in order.
TEMPLATE = {
    "date": "date",
    "source_row_id": "int",
    "company": "string",
    "item_description": "string",
    "product_family_level_1": "string",
    "brand_company": "string",
    "item_code": "string",
    "channel_raw": "string",
    "customer": "string",
    "sales_country": "string",
    "is_saliva_ejector": "string",
    "gross_sales_currency": "string",
    "quantity": "double",
    "gross_sales": "double",
}
TEMPLATE_FORCED_NULL = ("product_family_level_1",)
# Common schema of all landings, in order.
COMMON_SCHEMA = {
    "date": "date",
    "company": "string",
    "company_type": "string",
    "company_item_code": "string",
    "item_code": "string",
    "item_description": "string",
    "customer_raw": "string",
    "destination_country_raw": "string",
    "channel_raw": "string",
    "time_frames": "string",
    "volumes": "double",
    "quantity": "double",
    "sales": "double",
    "billing_currency": "string",
    "data_matrix": "string",
    "data_collection": "string",
    "project": "string",
    "file_name": "string",
}
COLLECTION = "sell-out"  # fixed value


class Target(NamedTuple):
    name: str
    type: str


def field_key(name: str) -> str:
    """Letters and digits of a column name, case folded, to match names across files."""
    return re.sub(r"[^a-z0-9]+", "", name.casefold())


def read_mapping(rows: Iterable[tuple[str, str, str]]) -> dict[str, Target]:
    """Mapping by field key from (original field, proposed field, data type) rows.

    Rows with a blank are skipped; a field mapped two ways or an unknown type is an error.
    """
    mapping: dict[str, Target] = {}
    clashes = []
    for original, proposed, data_type in rows:
        original, proposed = (original or "").strip(), (proposed or "").strip()
        data_type = (data_type or "").strip().upper()
        if not (original and proposed and data_type):
            continue
        if data_type not in MAPPING_TYPES:
            raise ValueError(f"Unsupported data type: {data_type}")
        target = Target(proposed, MAPPING_TYPES[data_type])
        if mapping.setdefault(field_key(original), target) != target:
            clashes.append(original)
    if clashes:
        raise ValueError(f"Conflicting mapping rows for {sorted(clashes)}")
    return mapping


def _folded_letters() -> dict[str, str]:
    """The few letters outside ASCII that case folding turns into ASCII ones, which Spark's ``lower`` does not all do."""
    return {chr(c): key for c in range(0x80, 0x10000) if (key := field_key(chr(c)))}


def mapping_from_table(table: DataFrame, columns: Iterable[str]) -> dict[str, Target]:
    """Mapping of the given source columns from a table of any length.

    Rows are reduced to the columns' keys on the cluster; two targets of a key are enough to see a conflict,
    so at most two rows per column come back. Rows with a blank are skipped.
    """
    names = ("original_field", "proposed_field", "data_types_found")
    original, proposed, kind = (F.trim(F.coalesce(F.col(name), F.lit(""))) for name in names)
    folded = original
    for letter, key in _folded_letters().items():
        folded = F.replace(folded, F.lit(letter), F.lit(key))
    key = F.regexp_replace(F.lower(folded), "[^a-z0-9]+", "")
    wanted = sorted({field_key(name) for name in columns})
    rows = table.where((original != "") & (proposed != "") & (kind != "")).where(key.isin(wanted))
    target = F.struct(proposed.alias("proposed"), F.upper(kind).alias("kind"))
    found = rows.groupBy(key.alias("key")).agg(F.min(target).alias("low"), F.max(target).alias("high")).collect()
    return read_mapping(
        (r["key"], side["proposed"], side["kind"]) for r in found for side in (r["low"], r["high"])
    )


def _period_columns(df: DataFrame, mapping: Mapping[str, Target]) -> dict[str, Column]:
    """First source column of each period target."""
    found: dict[str, Column] = {}
    for name in df.columns:
        target = mapping.get(field_key(name))
        if target and target.name in PERIOD_TARGETS:
            found.setdefault(target.name, F.col(f"`{name}`"))
    return found


def _period_parts(period: Mapping[str, Column], formats) -> list[tuple[str, Column]]:
    """Readable parts of the period, most specific first, with the tag each implies."""
    readers = {
        "date": ("month", lambda c: dates.parse_date(c, formats)),
        "month": ("month", dates.month_number),
        "quarter": ("quarter", dates.quarter_month),
        "semester": ("half-year", dates.half_month),
        "year": ("year", dates.year_number),
    }
    return [(k, tag, read(period[k])) for k, (tag, read) in readers.items() if k in period]


def report_date(df: DataFrame, mapping: Mapping[str, Target], formats=dates.DATE_FORMATS) -> Column:
    """Date of a line: its own date, else the first day of its period."""
    parts = {k: value for k, _, value in _period_parts(_period_columns(df, mapping), formats)}
    if "year" not in parts:
        if "date" not in parts:
            raise ValueError("No source column is mapped to year or date")
        return parts["date"]
    months = [parts[k] for k in ("month", "quarter", "semester") if k in parts]
    built = F.make_date(parts["year"], F.coalesce(*months, F.lit(1)), F.lit(1))
    return F.coalesce(parts["date"], built) if "date" in parts else built


def report_time_frame(df: DataFrame, mapping: Mapping[str, Target], formats=dates.DATE_FORMATS) -> Column:
    """Tag of the most specific period part that could be read."""
    parts = _period_parts(_period_columns(df, mapping), formats)
    if not parts:
        raise ValueError("No period column found")
    return F.coalesce(*[F.when(value.isNotNull(), tag) for _, tag, value in parts])


def import_mapped(
    df: DataFrame,
    mapping: Mapping[str, Target],
    file_name: str,
    batch_id: str | None = None,
    template: Mapping[str, str] | None = None,
    forced_null: Sequence[str] = (),
    formats: Sequence[str] = dates.DATE_FORMATS,
    fail_on_missing_date: bool = True,
) -> DataFrame:
    """Rename and cast a source table by its mapping, derive the date, add lineage.

    Several source columns of one target are coalesced in source order. Without a
    ``template`` an unmapped source column is an error; with one, unmapped columns are
    skipped and absent outputs are NULL. Unreadable numbers become NULL, and a row without
    a date fails the job that reads it.
    """
    sources: dict[str, list[Column]] = {}
    unmapped = []
    for name in df.columns:
        target = mapping.get(field_key(name))
        if target is None:
            unmapped.append(name)
        elif target.name not in PERIOD_TARGETS and target.name not in forced_null:
            wanted = template.get(target.name) if template else target.type
            if wanted is not None:
                sources.setdefault(target.name, []).append(F.col(f"`{name}`").try_cast(wanted))
    if unmapped and template is None:
        raise ValueError(f"No mapping for columns {unmapped}")

    date = report_date(df, mapping, formats)
    if fail_on_missing_date:
        date = F.coalesce(date, F.raise_error(F.lit("Row without a readable date")).cast("date"))
    columns = {"date": date} | {n: F.coalesce(*parts) for n, parts in sources.items()}
    if template:
        columns = {
            name: columns.get(name, F.lit(None)).cast(kind) for name, kind in template.items()
        }
    lined = _with_lineage(columns, report_time_frame(df, mapping, formats), file_name)
    if batch_id is not None:
        lined["batch_id"] = F.lit(batch_id)
    return df.select(*[value.alias(name) for name, value in lined.items()])


def _with_lineage(columns: Mapping[str, Column], time_frame: Column, file_name: str) -> dict[str, Column]:
    """Place the period tag before ``quantity`` and lineage after the sales value."""
    value = next((c for c in ("gross_sales", "gross_sales_with_charges") if c in columns), None)
    if value is None or "quantity" not in columns:
        raise ValueError("An import needs quantity and a gross sales column")
    lined: dict[str, Column] = {}
    for name, column in columns.items():
        if name == "quantity":
            lined["time_frames"] = time_frame
            lined["volumes"] = F.lit(None).cast("double")
        lined[name] = column
        if name == value:
            lined["data_matrix"] = F.lit(None).cast("string")
            lined["data_collection"] = F.lit(COLLECTION)
            lined["project"] = F.lit(COLLECTION)
            lined["file_name"] = F.lit(file_name)
    return lined


# ------------------------------------------------------------------------ common schema


def to_common(
    df: DataFrame, field_map: Mapping[str, str | None], schema: Mapping[str, str] = COMMON_SCHEMA
) -> DataFrame:
    """Common schema of a landing: a field is a column, else a literal, else NULL."""

    def field(name: str, kind: str) -> Column:
        source = field_map.get(name)
        column = F.col(f"`{source}`") if source in df.columns else F.lit(source)
        return (column.try_cast(kind) if source is not None else column.cast(kind)).alias(name)

    selected = df.select(*[field(name, kind) for name, kind in schema.items()])
    return selected.withColumn("company", canonical_company(F.col("company")))


def union_sources(
    sources: Mapping[str, DataFrame | None],
    field_maps: Mapping[str, Mapping[str, str | None]],
    batch_id: str | None = None,
) -> DataFrame:
    """Union of all landings that exist, in the common schema, optionally of one batch.

    A missing landing is skipped. An empty one needs no probe: it adds no rows.
    """
    parts = []
    for name, df in sources.items():
        if df is None or name not in field_maps:
            continue
        if batch_id is not None:
            df = df.filter(F.col("batch_id") == batch_id)
        parts.append(to_common(df, field_maps[name]))
    if not parts:
        raise ValueError("No landing table is available")
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


# Column names under which landings hold the reference fields.
REFERENCE_CANDIDATES = {
    "company": ("company", "dealer", "warehouse_or_depot", "brand_company"),
    "customer_raw": ("customer_raw", "customer", "wholesale_customer", "customer_group"),
    "clean_customer": ("clean_customer", "customer_clean", "customer_cleaned", "customer_pulito"),
    "country_raw": ("country", "country_raw"),
    "destination_country_raw": (
        "destination_country_raw", "sales_country", "country_sales", "destination_country",
    ),
    "channel_raw": ("channel_raw",),
}


def reference_fields(df: DataFrame, landing: str, field_map: Mapping[str, str | None]) -> DataFrame:
    """Company, customer, country and channel texts of a landing, one row per combination."""

    def pick(field: str) -> Column | None:
        name = pick_column(df, (field_map.get(field), *REFERENCE_CANDIDATES[field]))
        return None if name is None else F.trim(F.col(f"`{name}`").cast("string"))

    null = F.lit(None).cast("string")
    found = {field: pick(field) for field in REFERENCE_CANDIDATES}
    raw = {field: null if column is None else column for field, column in found.items()}
    picked = df.select(
        F.coalesce(
            canonical_company(raw["company"]),
            canonical_company(F.lit(company_from_landing_name(landing))),
        ).alias("company"),
        raw["destination_country_raw"].alias("destination_country_raw"),
        raw["customer_raw"].alias("customer_raw"),
        F.coalesce(raw["clean_customer"], raw["customer_raw"]).alias("customer"),
        raw["country_raw"].alias("country_raw"),
        raw["channel_raw"].alias("channel_raw"),
    )
    described = F.coalesce("destination_country_raw", "customer_raw", "country_raw", "channel_raw")
    return picked.filter((F.col("company") != "") & described.isNotNull()).distinct()
