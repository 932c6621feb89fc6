"""Building the reference tables of the harmonised layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.companies import canonical_company, join_key
from tradeloom.functions.text import decimal_text
from tradeloom.operators.joins import lookup_join
from tradeloom.operators.lookup import lookup_channel, standardise_country
from tradeloom.operators.surrogate import with_surrogate
from tradeloom.sources.mapping import reference_fields

MONTH_FRAME = 4  # fixed value: id of the monthly time frame


def _month_times(times: DataFrame) -> DataFrame:
    return times.filter(F.col("month").cast("int").between(1, 12)).select(
        F.col("id").cast("long").alias("id_time"),
        F.col("year").cast("int").alias("year"),
        F.col("semester").cast("int").alias("semester"),
        F.col("quarter").cast("int").alias("quarter"),
        F.col("month").cast("int").alias("month"),
        F.col("id_time_frame").cast("int").alias("id_time_frame"),
    )


def _currency_codes(currencies: DataFrame) -> DataFrame:
    return currencies.select(
        F.col("id").cast("long").alias("id_currency"),
        join_key(F.col("currency_code")).alias("currency_code"),
    )


def country_currency(
    links: DataFrame, countries: DataFrame, currencies: DataFrame, times: DataFrame
) -> DataFrame:
    """Local currency of every country and month."""
    named = countries.select(
        F.col("id").cast("long").alias("id_country"), F.trim("country_name").alias("country_name")
    ).filter(F.col("country_name") != "")
    coded = _currency_codes(currencies).filter(F.col("currency_code") != "")
    return (
        links.select("id_country", "id_currency", "id_time")
        .distinct()
        .join(_month_times(times).drop("id_time_frame"), "id_time")
        .join(named, "id_country")
        .join(coded, "id_currency")
        .select(
            "id_time",
            "year",
            "semester",
            "quarter",
            "month",
            "id_country",
            "country_name",
            F.upper("country_name").alias("country_join_key"),
            "id_currency",
            F.col("currency_code").alias("currency_target"),
            F.col("currency_code").alias("local_currency"),
        )
        .distinct()
    )


def exchange_rates(
    rates: DataFrame, currencies: DataFrame, times: DataFrame, prefer_valid: bool = False
) -> DataFrame:
    """One rate per month and currency pair: the quote with the lowest id.

    Rates are text with a decimal comma; unreadable or non-positive ones become NULL. With
    ``prefer_valid`` the lowest id among valid quotes wins instead.
    """
    number = decimal_text(F.col("exchange_rate"))
    codes = _currency_codes(currencies)
    quotes = (
        rates.select(
            F.col("id").cast("long").alias("id_exchange_rate"),
            F.col("id_time").cast("long").alias("id_time"),
            F.col("id_currency_base").cast("long").alias("id_currency_base"),
            F.col("id_currency_target").cast("long").alias("id_currency_target"),
            F.when(number > 0, number).alias("exchange_rate"),
        )
        .join(_month_times(times).filter(F.col("id_time_frame") == MONTH_FRAME), "id_time")
        .join(
            codes.select(
                F.col("id_currency").alias("id_currency_base"),
                F.col("currency_code").alias("currency_base"),
            ),
            "id_currency_base",
        )
        .join(
            codes.select(
                F.col("id_currency").alias("id_currency_target"),
                F.col("currency_code").alias("currency_target"),
            ),
            "id_currency_target",
        )
    )
    keys = ["year", "month", "currency_base", "currency_target"]
    carried = [
        "id_exchange_rate", "id_time", "semester", "quarter", "id_time_frame",
        "id_currency_base", "id_currency_target", "exchange_rate",
    ]
    rank = F.struct(
        (F.col("exchange_rate").isNull() & F.lit(prefer_valid)).alias("invalid"),
        F.col("id_exchange_rate"),
    )
    return quotes.groupBy(*keys).agg(F.min_by(F.struct(*carried), rank).alias("first")).select(
        "first.id_exchange_rate",
        "first.id_time",
        "year",
        "first.semester",
        "first.quarter",
        "month",
        "first.id_time_frame",
        "first.id_currency_base",
        "currency_base",
        "first.id_currency_target",
        "currency_target",
        "first.exchange_rate",
    )


# ---------------------------------------------------------------------------- products


def product_extras(attributes: DataFrame, fields: DataFrame, allowed: DataFrame) -> DataFrame:
    """``field=value`` list per product, sorted by field; attributes without a value drop out.

    Equal pairs are merged before they are collected, so a product gathers at most its
    distinct attribute values.
    """
    value = F.coalesce(
        F.col("val_label"),
        F.col("val_text"),
        F.col("val_decimal").cast("string"),
        F.col("val_integer").cast("string"),
        F.col("val_boolean").cast("string"),
        F.date_format("val_date", "yyyy-MM-dd"),
        F.col("source_raw_val"),
    )
    coded = attributes.join(
        fields.select(F.col("id").alias("id_prod_extra_attrib_field"), "field_code"),
        "id_prod_extra_attrib_field",
    )
    labelled = lookup_join(
        coded,
        allowed.groupBy("id").agg(F.min("val_label").alias("val_label")),
        {"id": F.col("id_prod_extra_attrib_allowed_val")},
        ["val_label"],
    )
    pairs = (
        labelled.select("id_prod", "field_code", value.alias("val"))
        .filter(F.col("val").isNotNull())
        .groupBy("id_prod", "field_code", "val")
        .agg(F.count("*").alias("times"))
    )
    return (
        pairs.groupBy("id_prod")
        .agg(F.array_sort(F.collect_list(F.struct("field_code", "val", "times"))).alias("_pairs"))
        .select(
            "id_prod",
            F.array_join(
                F.flatten(
                    F.transform(
                        "_pairs",
                        lambda p: F.array_repeat(
                            F.concat_ws("=", p["field_code"], p["val"]), p["times"].cast("int")
                        ),
                    )
                ),
                "; ",
            ).alias("extra"),
        )
    )


# Master table of each single-column product attribute.
PRODUCT_LOOKUPS = {
    "customer": ("companies", "id_dealer", "company_name"),
    "brand": ("brands", "id_brand", "brand"),
    "prefix_code": ("prefix_codes", "id_prefix_code", "prefix_code"),
    "father_name": ("father_names", "id_father_name", "father_name"),
    "pack": ("packs", "id_pack", "pack"),
    "feature": ("features", "id_feature", "feature"),
    "measure": ("measures", "id_measure", "measure"),
}


def product_owners(products: DataFrame) -> DataFrame:
    """``company, item_code, id_prod``: the lowest product id of each canonical company and item."""
    item = F.split_part("company_item_code", F.lit("|"), F.lit(2))
    company = canonical_company(F.split_part("company_item_code", F.lit("|"), F.lit(1)))
    owners = products.select(
        F.col("id").alias("id_prod"), company.alias("company"), item.alias("item_code")
    )
    return owners.groupBy("company", "item_code").agg(F.min("id_prod").alias("id_prod"))


def product_master(
    versions: DataFrame,
    products: DataFrame,
    tables: Mapping[str, DataFrame],
    extras: DataFrame,
    owners: DataFrame | None = None,
) -> DataFrame:
    """One row per canonical company and item: newest version, first packing.

    ``tables``: ``companies, brands, prefix_codes, father_names, packs, features, measures,
    master_code, mc_lvl1, mc_lvl2, mc_lvl3, pack_qty, pack_measure_units``, each keyed by
    ``id``. Winners are chosen before the lookups, so every join is one to one. ``owners`` is
    ``product_owners(products)`` if that is known; with a part of it, the versions, packings
    and extras of its products are enough.
    """
    owners = product_owners(products) if owners is None else owners
    newest = (
        versions.groupBy("id_prod")
        .agg(
            F.max_by(F.struct(*versions.columns), F.struct("version", "id")).alias("row")
        )
        .select("row.*")
    )
    found = lookup_join(newest.join(owners, "id_prod"), extras, {"id_prod": F.col("id_prod")}, ["extra"])

    for name, (table, key, column) in PRODUCT_LOOKUPS.items():
        found = lookup_join(
            found, tables[table].select("id", F.col(column).alias(name)), {"id": F.col(key)}, [name]
        )

    def level(n: int) -> DataFrame:
        return tables[f"mc_lvl{n}"].select(
            F.col("id").alias(f"id_mc_lvl{n}"),
            F.lpad(F.col("code").cast("string"), 2, "0").alias(f"_code{n}"),
        )

    codes = tables["master_code"]
    for n in (1, 2, 3):
        codes = codes.join(level(n), f"id_mc_lvl{n}", "left")
    codes = codes.select("id", F.concat_ws("_", "_code1", "_code2", "_code3").alias("mc_code"))
    found = lookup_join(found, codes, {"id": F.col("id_mc")}, ["mc_code"])
    found = found.withColumn("mc_code", F.coalesce("mc_code", F.lit("")))

    first_pack = (
        tables["pack_qty"]
        .groupBy("id_prod_version")
        .agg(
            F.min_by(F.struct("inner_count", "inner_qty", "id_pack_measure_unit"), "id").alias("row")
        )
        .select("id_prod_version", "row.*")
    )
    packing = lookup_join(
        first_pack,
        tables["pack_measure_units"].select("id", F.col("measure_unit").alias("pack_measure_unit")),
        {"id": F.col("id_pack_measure_unit")},
        ["pack_measure_unit"],
    )
    packed = ["inner_count", "inner_qty", "pack_measure_unit"]
    found = lookup_join(found, packing, {"id_prod_version": F.col("id")}, packed)
    return found.select(
        "company",
        "item_code",
        "description",
        "customer",
        "brand",
        "prefix_code",
        "father_name",
        "mc_code",
        "pack",
        "inner_count",
        "inner_qty",
        "pack_measure_unit",
        "feature",
        "measure",
        "extra",
    )


# --------------------------------------------------------------------------- customers

CUSTOMER_GRAIN = ("company", "destination_country_raw", "customer_raw")


def collect_reference_fields(
    landings: Mapping[str, DataFrame], field_maps: Mapping[str, Mapping[str, str | None]]
) -> DataFrame:
    """Distinct customer, country and channel texts of all landings."""
    first, *rest = [reference_fields(df, name, field_maps.get(name, {})) for name, df in landings.items()]
    for part in rest:
        first = first.unionByName(part)
    return first.distinct()


def customer_channel_ref(
    fields: DataFrame,
    dictionary: DataFrame,
    countries: DataFrame,
    aliases: DataFrame,
    channels: DataFrame,
) -> DataFrame:
    """One validated row per company, raw destination and raw customer, numbered in order."""
    base = fields.groupBy(*CUSTOMER_GRAIN).agg(
        *[F.min(c).alias(c) for c in ("customer", "country_raw", "channel_raw")]
    )
    raw_names = base.select(
        F.explode(F.array("destination_country_raw", "country_raw")).alias("name")
    )
    resolved = standardise_country(raw_names, "name", dictionary, countries, aliases)
    by_key = resolved.groupBy(join_key(F.col("country_raw")).alias("name_key")).agg(
        F.min(F.struct(F.col("country").isNull(), "country", "id_country")).alias("best")
    ).select("name_key", "best.country", "best.id_country")

    def located(df: DataFrame, raw: str, id_name: str, name: str) -> DataFrame:
        renamed = by_key.select(
            "name_key", F.col("id_country").alias(id_name), F.col("country").alias(name)
        )
        return lookup_join(df, renamed, {"name_key": join_key(F.col(raw))}, [id_name, name])

    placed = located(base, "destination_country_raw", "id_destination_country", "destination_country")
    placed = located(placed, "country_raw", "id_country", "country")
    with_channel = lookup_channel(placed, channels)
    order: list[Column] = [F.col(c).asc_nulls_first() for c in CUSTOMER_GRAIN]
    return (
        with_surrogate(with_channel, order)
        .withColumn("validated", F.lit(True))
        .select(
            "utility_id",
            "company",
            "destination_country_raw",
            "id_destination_country",
            "destination_country",
            "customer_raw",
            "customer",
            "country_raw",
            "id_country",
            "country",
            "channel_raw",
            "id_channel",
            "channel",
            "validated",
        )
    )
