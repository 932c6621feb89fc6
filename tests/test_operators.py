import datetime
import random

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import fx, lookup, pricing, quality, reports
from tradeloom.operators.running import last_seen, running
from tradeloom.operators.surrogate import with_surrogate
from tradeloom.plans import valorise
from tradeloom.sources import mapping, sinks

D = datetime.date

# ----------------------------------------------------------------------- running, ids


def test_running_values_cross_blocks(spark, rows):
    df = spark.createDataFrame(
        [("a", n, n if n % 4 == 0 else None) for n in range(25)], "f string, i int, v int"
    )
    marked = last_seen("i", F.col("v").isNotNull(), F.col("v"))
    out = running(df, ["f"], "i", {"total": F.col("v")}, {"seen": marked}, block_rows=3)
    expected, total = [], 0
    for n in range(25):
        total += n if n % 4 == 0 else 0
        expected.append((n, total, n - n % 4))
    assert rows(out, "i", "total", "seen.value") == sorted(expected, key=repr)


def test_surrogate_ids_are_consecutive_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    out = with_surrogate(df, [F.col("k")], start=5).orderBy("k").collect()
    assert [(r["k"], r["utility_id"]) for r in out] == [(k, k + 6) for k in range(1000)]


# ------------------------------------------------------------------------------ sinks


def test_insert_only_is_idempotent_with_null_keys(spark):
    target = spark.createDataFrame([("a", None), ("b", "x")], "k string, c string")
    source = spark.createDataFrame([("a", None), ("b", None), ("c", "x")], "k string, c string")
    added = sinks.insert_only(target, source, ["k", "c"])
    assert sorted(tuple(r) for r in added.collect()) == [("b", None), ("c", "x")]
    assert sinks.insert_only(target.union(added), source, ["k", "c"]).isEmpty()


def test_tables_merge_and_verify(spark):
    first = spark.createDataFrame([(1, "a")], "k int, v string")
    sinks.merge_table(first, "merged", ["k"])
    sinks.merge_table(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), "merged", ["k"])
    assert sorted(tuple(r) for r in spark.table("merged").collect()) == [(1, "a"), (2, "c")]
    sinks.write_verified(first, "verified")
    found = sinks.existing_tables(spark, ["verified", "absent"])
    assert found["absent"] is None and found["verified"].count() == 1
    with pytest.raises(ValueError):
        sinks.require_tables(spark, ["absent"])


def test_replace_batch_does_not_double_count(spark):
    old = spark.createDataFrame([("b1", 1), ("b2", 2)], "batch_id string, v int")
    again = spark.createDataFrame([("b2", 3)], "batch_id string, v int")
    out = sinks.replace_batch(old, again).collect()
    assert sorted(tuple(r) for r in out) == [("b1", 1), ("b2", 3)]


# ----------------------------------------------------------------------------- lookups


def test_channel_matches_name_before_id_without_fan_out(spark, rows):
    channels = spark.createDataFrame([(1, "Retail"), (2, "1"), (3, "retail ")], "id int, name string")
    raw = spark.createDataFrame([("RETAIL",), ("1",), ("3",), ("none",), (None,)], "channel_raw string")
    out = lookup.lookup_channel(raw, channels)
    assert rows(out, "channel_raw", "id_channel") == sorted(
        [("RETAIL", 1), ("1", 2), ("3", 3), ("none", None), (None, None)], key=repr
    )


def test_ambiguous_country_fails(spark):
    dictionary = spark.createDataFrame([("Ita", 1), ("ITA ", 2)], "country_raw string, id_country int")
    countries = spark.createDataFrame([(1, "Italy")], "id int, country_name string")
    aliases = spark.createDataFrame([], "alias string, country_iso_name string")
    df = spark.createDataFrame([("ita",)], "c string")
    with pytest.raises(Exception, match="Ambiguous country"):
        lookup.standardise_country(df, "c", dictionary, countries, aliases).collect()


def test_best_reference_prefers_validated_then_complete_then_lowest_id(spark, rows):
    schema = (
        "utility_id int, company string, destination_country string, customer_raw string, "
        "customer string, country string, channel string, validated boolean"
    )
    reference = spark.createDataFrame(
        [
            (1, "A", "It", "x", None, None, None, True), (2, "a ", "IT", "X", "c", "c", "c", False),
            (3, "A", "It", "x", "c", None, None, True), (4, "A", "It", "x", "c", None, None, True),
            (5, "B", None, "x", None, None, None, None),
        ],
        schema,
    )
    assert rows(lookup.best_reference(reference), "utility_id") == [(3,), (5,)]
    facts = spark.createDataFrame(
        [("a", "it", "x", "it", "r"), ("B", None, "X", None, None), ("C", "it", "x", "it", "r")],
        "company string, destination_country string, customer_raw string, "
        "destination_country_raw string, channel_raw string",
    )
    out = lookup.enrich_customer_channel(facts, reference)
    assert rows(out, "company", "customer") == [("B", None), ("C", None), ("a", "c")]
    assert rows(lookup.unmatched_customers(facts, reference), "company") == [("C",)]


# ------------------------------------------------------------------------------ prices

LINE = (
    "id int, company string, company_type string, channel string, item_code string, "
    "destination_country string, billing_currency string, date date, sellout_dm string, "
    "quantity double, fx_transaction_lc double, time_frames string"
)


def line(number, **over):
    base = {
        "id": number, "company": "M", "company_type": "manufacturer", "channel": "Wholesale",
        "item_code": "i", "destination_country": "Spain", "billing_currency": "EUR",
        "date": D(2025, 3, 1), "sellout_dm": "fam", "quantity": 2.0, "fx_transaction_lc": 10.0,
        "time_frames": "semi-annual",
    }
    return tuple({**base, **over}.values())


def test_null_channel_and_unknown_type_are_unrouted(spark, rows):
    df = spark.createDataFrame(
        [line(1), line(2, channel=None), line(3, company_type="company"), line(4, channel="Retail")],
        LINE,
    )
    assert rows(pricing.split_panel(df), "id", "panel_segment") == [
        (1, "sellin_producer"), (2, "unrouted"), (3, "unrouted"), (4, "sellout"),
    ]


@pytest.mark.parametrize(
    ("family", "special"),
    [("SPX1", True), ("SP", False), ("14_2", True), ("1432", True), ("x_99", True), ("plain", False),
     (None, False)],
)
def test_special_families_use_like_wildcards(spark, family, special):
    column = pricing.is_special_family(F.lit(family).cast("string"))
    assert spark.range(1).select(column.alias("x")).first()["x"] is special


def test_unknown_sellout_amount_is_not_zero(spark):
    flag = pricing.sellout_flag(F.lit(None).cast("double"), F.lit(1.0), F.lit("x"))
    assert spark.range(1).select(flag.alias("x")).first()["x"] == 3


PRICES = "company string, item_code string, _dest_key string, billing_currency string, _year int, _semester string, pm_omogeneo double"


def test_geo_fallback_takes_first_country_and_never_fans_out(spark, rows):
    def price(country, value):
        return ("M", "i", country, "EUR", 2025, "H1", value)

    prices = spark.createDataFrame([price("ITALY", 1.0), price("PORTUGAL", 2.0)], PRICES)
    asked = spark.createDataFrame(
        [price("SPAIN", None), price("SPAIN", 9.0), price("ANDORRA", None)], PRICES
    )
    out = pricing.geo_fallback(asked, prices)
    assert rows(out, "_dest_key", "pm_omogeneo") == [
        ("ANDORRA", None), ("SPAIN", 2.0), ("SPAIN", 9.0),
    ]


def test_asof_price_looks_back_unless_told_otherwise(spark, rows):
    def price(year, half, value):
        return ("M", "i", "SPAIN", "EUR", year, half, value)

    prices = spark.createDataFrame([price(2024, "H1", 1.0), price(2025, "H2", 5.0)], PRICES)
    asked = spark.createDataFrame(
        [price(2023, "H2", None), price(2024, "H2", None), price(2026, "H1", None)], PRICES
    )
    back = pricing.asof_price(asked, prices)
    assert rows(back, "_year", "pm_omogeneo") == [(2023, None), (2024, 1.0), (2026, 5.0)]
    newest = pricing.asof_price(asked, prices, allow_future=True)
    assert {r["pm_omogeneo"] for r in newest.collect()} == {5.0}


def test_valued_sellin_segments_and_flags(spark, rows):
    df = spark.createDataFrame(
        [
            line(1), line(2, quantity=3.0, fx_transaction_lc=20.0), line(3, quantity=0.0),
            line(4, sellout_dm="SP_1", fx_transaction_lc=8.0), line(5, item_code=None),
            line(6, company="D", company_type="dealer", quantity=4.0, fx_transaction_lc=1.0),
            line(7, company="D", company_type="dealer", channel="Retail", fx_transaction_lc=24.0),
        ],
        LINE,
    )
    lines = pricing.split_panel(pricing.with_price_columns(df))
    out = valorise.valued_sellin(lines)
    found = {r["id"]: r for r in out.collect()}
    assert sorted(found) == [1, 2, 3, 4, 5, 6]  # the retail line stays sell-out
    assert [found[n]["is_no_media"] for n in range(1, 7)] == [0, 0, 1, 2, 3, 0]
    assert found[1]["pm_omogeneo"] == 6.0 and found[1]["amount_homogeneous"] == 12.0
    assert found[3]["amount_homogeneous"] == 0.0
    assert found[4]["pm_omogeneo"] == 4.0 and found[4]["amount_homogeneous"] == 8.0
    assert found[5]["amount_homogeneous"] is None
    assert found[6]["pm_omogeneo"] == pytest.approx(6.0)  # retail 12 over markup 2
    assert found[6]["amount_sellout"] == pytest.approx(48.0)


def test_period_split_conserves_quantity_and_moves_the_date(spark):
    df = spark.createDataFrame(
        [line(1, date=D(2025, 8, 31), quantity=100.0), line(2, time_frames="quarterly"),
         line(3, company_type="dealer")],
        LINE,
    )
    out = pricing.split_periods(df)
    parts = {}
    for r in out.collect():
        parts.setdefault(r["id"], []).append(r)
    assert sorted(len(v) for v in parts.values()) == [1, 2, 2]
    assert sum(r["quantity"] for r in parts[1]) == pytest.approx(100.0)
    assert sorted(r["date"] for r in parts[1]) == [D(2025, 8, 31), D(2026, 2, 1)]
    assert {r["_original_period"] for r in parts[1]} == {"2025_H2"}
    assert sorted(r["quantity"] for r in parts[2]) == [1.0, 1.0]


# --------------------------------------------------------------------------------- fx

RATE = "year int, month int, currency_base string, currency_target string, country_name string, exchange_rate double, event_type string, source string"


def test_cumulative_factor_is_exact_and_ends_at_the_current_currency(spark):
    switches = spark.createDataFrame(
        [
            (2018, 8, "Venezuela", "VEF", "VES", 100000.0, "redenomination"),
            (2021, 9, "Venezuela", "VES", "VES", 7324980.0, "redenomination"),
            (2009, 1, "Zimbabwe", "USD", "ZWL", None, "currency_reintroduction"),
        ],
        "year int, month int, country_name string, currency_predecessor string, "
        "currency_successor string, factor double, event_type string",
    )
    found = {(r["country_name"], r["year"]): r["factor_cum"] for r in fx.cumulative_factor(switches).collect()}
    assert found[("Venezuela", 2018)] == 732498000000.0
    assert found[("Venezuela", 2021)] == 7324980.0
    assert found[("Zimbabwe", 2009)] is None


def test_union_rows_equal_to_their_base_drop_out(spark):
    fx_rows = spark.createDataFrame(
        [(2022, 1, "EUR", "HRK", "Croatia", 7.5345, "df_original"),
         (2022, 1, "USD", "HRK", "Croatia", 6.6, "df_original")],
        "year int, month int, currency_base string, currency_target string, country_name string, "
        "exchange_rate double, source string",
    )
    steps = spark.createDataFrame(
        [(2022, 1, "HRK", "EUR", "Croatia", 1 / 7.5345, "currency_union", "df_redenomination")], RATE
    )
    out = fx.backcalc(fx_rows, steps).collect()
    assert [(r["currency_base"], r["currency_target"]) for r in out] == [("USD", "EUR")]
    assert out[0]["exchange_rate"] == pytest.approx(6.6 / 7.5345)


def test_inverse_and_cross_rates_are_consistent(spark):
    normalised = spark.createDataFrame(
        [(2024, 1, "USD", c, n, r, None, "df_original")
         for c, n, r in (("GBP", "UK", 0.8), ("CHF", "CH", 0.9), ("JPY", "JP", 150.0))],
        RATE,
    )
    crossed = {
        (r["currency_base"], r["currency_target"]): r["exchange_rate"]
        for r in fx.cross(normalised).collect()
    }
    assert len(crossed) == 6
    for (base, target), rate in crossed.items():
        assert rate * crossed[(target, base)] == pytest.approx(1.0)
    inverted = {r["currency_base"]: r["exchange_rate"] for r in fx.inverse(normalised).collect()}
    assert inverted == pytest.approx({"GBP": 1 / 0.8, "CHF": 1 / 0.9, "JPY": 1 / 150.0})


def test_legacy_keeps_rows_without_an_event(spark):
    clean = spark.createDataFrame(
        [(2000, 1, "USD", "DEM", 2.0), (2000, 1, "USD", "GBP", 0.5)],
        "year int, month int, currency_base string, currency_target string, exchange_rate double",
    )
    normalised = spark.createDataFrame([(2000, 1, "GBP", "USD", "UK", 2.0, None, "df_inverted")], RATE)
    out = fx.legacy(clean, fx.events_table(spark), normalised).collect()
    assert [(r["currency_base"], r["currency_target"], r["exchange_rate"]) for r in out] == [
        ("DEM", "GBP", 0.25)
    ]


# ------------------------------------------------------------------------------ reports


def test_block_ends_when_its_total_is_reached(spark, rows):
    blank = None
    sheet = [
        ("EQUIP", "Chairs", 30.0), (blank, "A", 10.0), (blank, "B", 20.0), (blank, "Lamps", 5.0),
        (blank, "C", 5.0), (blank, "MARCA 4 (rellenar con nombre de la marca)", blank),
        (blank, "X-ray", 7.0), (blank, "D", blank), (blank, "E", 7.0), ("OTHER", "Sub", 1.0),
        (blank, "F", 1.0),
    ]
    df = spark.createDataFrame(
        [("f", n, *row) for n, row in enumerate(sheet)],
        "file_id string, row_idx int, familia string, label string, value double",
    )
    assert rows(reports.block_segments(df), "row_idx", "family", "subfamily", "brand") == sorted(
        [(1, "EQUIP", "Chairs", "A"), (2, "EQUIP", "Chairs", "B"), (4, "EQUIP", "Lamps", "C"),
         (8, "EQUIP", "X-ray", "E"), (10, "OTHER", "Sub", "F")],
        key=repr,
    )


def plain_brands(sheet):
    """Brand rows of one sheet, walked row by row."""
    out, family, head, total, seen, opening = [], None, None, None, 0.0, True
    for at, (familia, label, value) in enumerate(sheet):
        if label.startswith("MARCA"):
            opening = True
            continue
        if familia is not None:
            family, opening = familia, True
        if opening or (total is not None and seen >= total):
            head, total, seen, opening = label, value, 0.0, False
        elif value is not None:
            out.append((at, family, head, label, value))
            seen += value
    return out


@pytest.mark.parametrize("kind", ["totals", "wild", "one_head", "zeros"])
def test_long_segments_are_walked_in_parts(spark, rows, kind):
    chance = random.Random(kind)
    sheet = [("FAMILY", "head 0", None if kind == "one_head" else 12.0)]
    while len(sheet) < 3_000:
        n = len(sheet)
        if kind == "totals":  # heads whose brands add up, over up to 400 rows
            brands = [float(chance.randint(1, 9)) for _ in range(chance.choice([1, 5, 400]))]
            sheet += [(None, f"head {n}", sum(brands)), *[(None, f"brand {n}", v) for v in brands]]
        elif kind == "wild":  # any figures, negative and absent ones too, and a few new segments
            value = chance.choice([None, 0.0, *map(float, range(-5, 40))])
            mark = chance.random()
            label = "MARCA 4 (rellenar con nombre de la marca)" if mark < 0.001 else f"row {n}"
            sheet.append(("NEXT" if mark > 0.999 else None, label, value))
        else:
            sheet.append((None, f"row {n}", 0.0 if kind == "zeros" else float(n % 7)))
    df = spark.createDataFrame(
        [("f", n, *row) for n, row in enumerate(sheet)],
        "file_id string, row_idx int, familia string, label string, value double",
    )
    names = ("row_idx", "family", "subfamily", "brand", "quantity")
    assert rows(reports.block_segments(df, 128), *names) == sorted(plain_brands(sheet), key=repr)
    assert rows(reports.block_segments(df), *names) == sorted(plain_brands(sheet), key=repr)


def test_a_segment_of_100_000_rows_uses_many_tasks(spark):
    n, part = 100_000, 5_000
    df = spark.range(n).select(
        F.lit("f").alias("file_id"), F.col("id").alias("row_idx"), F.when(F.col("id") == 0, "F").alias("familia"),
        F.concat(F.lit("row "), F.col("id")).alias("label"),
        F.when(F.col("id") % 1000 == 0, 999.0).otherwise(1.0).alias("value"),
    )
    out = reports.block_segments(df, part)
    found = out.groupBy("subfamily").agg(F.count("*").alias("n"), F.min("row_idx").alias("first")).collect()
    assert {(r["subfamily"], r["n"], r["first"]) for r in found} == {
        (f"row {head}", 999, head + 1) for head in range(0, n, 1000)
    }
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small parts keep their tasks
    try:
        tasks = out.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) > 1


def test_brand_landing_reads_period_and_country(spark):
    cells = spark.createDataFrame(
        [("f", 1, 0, "espa\u00f1a"), ("f", 0, 0, "x"), ("g", 1, 0, " costa RICA "), ("h", 0, 0, "no title")],
        "file_id string, row_idx int, col_idx int, text string",
    )
    names = spark.createDataFrame(
        [("f", "acme_global_2026_q2.xlsx"), ("g", "acme_7_global_2025_h2.xlsx"), ("h", "acme_global_2024_03.xlsx")],
        "file_id string, file_name string",
    )
    brands = spark.createDataFrame(
        [(f, 1, "Fam", "Sub", "B", 2.0) for f in "fgh"],
        "file_id string, row_idx long, family string, subfamily string, brand string, quantity double",
    )
    files = names.join(reports.sheet_countries(cells), "file_id")
    found = reports.brand_landing(brands, files).orderBy("file_name").collect()
    assert [(str(r["date"]), r["company"], r["country"], r["period_type"]) for r in found] == [
        ("2025-07-01", "Acme_7", "Costa Rica", "semi-annual"),
        ("2024-03-01", "Acme", None, "monthly"),
        ("2026-04-01", "Acme", "Spain", "quarterly"),
    ]
    with pytest.raises(Exception, match="No period in the file name"):
        reports.brand_landing(brands, files.withColumn("file_name", F.lit("notes.xlsx"))).collect()


def test_span_expansion_matches_a_plain_layout(spark, rows):
    cells = [
        (0, 0, 2, 2, "corner"), (0, 1, 1, 3, "tall"), (0, 2, 2, 1, "wide"),
        (1, 0, 1, 1, "a"), (1, 1, 1, 1, "b"), (2, 0, 1, 1, "c"), (2, 1, 1, 1, "d"),
        (2, 2, 2, 1, "e"), (3, 0, 3, 1, "x"), (3, 1, 1, 1, "y"),
    ]
    df = spark.createDataFrame(
        [("f", *c, None) for c in cells],
        "file_id string, row_idx int, cell_idx int, colspan int, rowspan int, text string, num double",
    )
    grid = {}
    for row, _, colspan, rowspan, label in cells:
        column = next(c for c in range(99) if (row, c) not in grid)
        for r in range(row, row + rowspan):
            for c in range(column, column + colspan):
                grid[(r, c)] = label
    expected = sorted(((r, c, label) for (r, c), label in grid.items()), key=repr)
    assert rows(reports.span_expand(df), "row_idx", "col_idx", "text") == expected


def test_hierarchy_head_closes_deeper_levels(spark):
    sheet = [("01", "One"), ("0101", "One-A"), ("P1x", "leaf"), ("02", "Two"), ("P2x", "leaf"),
             ("Result", "sum"), ("0201", "Two-A"), ("020101", "Deep"), ("P3x", "leaf")]
    df = spark.createDataFrame(
        [("f", n, *row) for n, row in enumerate(sheet)],
        "file_id string, row_idx int, code string, description string",
    )
    found = {r["code"]: r["item_categories"] for r in reports.hierarchy_leaves(df).collect()}
    assert found == {"P1x": ["One", "One-A"], "P2x": ["Two"], "P3x": ["Two", "Two-A", "Deep"]}


def test_repeated_keys_add_up_when_files_are_merged(spark):
    df = spark.createDataFrame(
        [("k", "i", "desc q", "quantity", 1.0, "q.xlsx"), ("k", "i", "desc q", "quantity", 2.0, "q.xlsx"),
         ("k", "i", "desc v", "gross_sales", 9.0, "v.xlsx"), ("k", "j", "only v", "gross_sales", 4.0, "v.xlsx")],
        "dataset_key string, item_code string, item_description string, metric_type string, "
        "value double, file_name string",
    )
    out = reports.merge_metric_files(df, ("dataset_key", "item_code")).orderBy("item_code").collect()
    assert [tuple(r[c] for c in ("item_description", "quantity", "gross_sales", "file_name")) for r in out] == [
        ("desc q", 3.0, 9.0, "q.xlsx | v.xlsx"), ("only v", 0.0, 4.0, "v.xlsx"),
    ]


def test_mapping_of_a_long_table(spark):
    rows = [(f"Other {i}", "sales", "FLOAT") for i in range(20_000)] + [(" Item-Code ", "item_code", "string")] * 2
    table = spark.createDataFrame(rows, "original_field string, proposed_field string, data_types_found string")
    kind = next(iter(mapping.MAPPING_TYPES))
    table = table.withColumn("data_types_found", F.lit(kind))
    found = mapping.mapping_from_table(table, ["ITEM CODE", "unmapped"])
    assert found == {"itemcode": mapping.Target("item_code", mapping.MAPPING_TYPES[kind])}
    clash = table.unionAll(table.limit(1).select(F.lit("item code"), F.lit("sales"), F.lit(kind)))
    with pytest.raises(ValueError, match="Conflicting"):
        mapping.mapping_from_table(clash, ["item_code"])


def test_failed_checks_are_all_named(spark):
    checks = spark.createDataFrame([(f"check_{i:03d}", i % 2 == 0) for i in range(400)], "check_name string, passed boolean")
    with pytest.raises(ValueError) as caught:
        quality.require_passed(checks)
    assert str(caught.value).count("check_") == 200


def test_columns_are_picked_in_any_case(spark):
    df = spark.createDataFrame([(1, 2)], "`ID_Channel` int, `Name` int")
    assert lookup.pick_column(df, ["id", None, "id_channel"]) == "ID_Channel"
    assert lookup.pick_column(df, ["code"]) is None


def test_a_file_without_metric_fails_the_merge(spark):
    lines = spark.createDataFrame(
        [("a", "2024-01-01", "x", None, 1.0, "a_2024.xlsx")],
        "dataset_key string, date string, item_code string, metric_type string, value double, file_name string",
    )
    with pytest.raises(Exception, match="Unknown metric"):
        reports.merge_metric_files(lines).collect()


def test_one_row_is_staged_for_each_unknown_key(spark):
    found = spark.createDataFrame(
        [("FOO", "foo"), ("FOO", "Foo"), ("BAR", "bar")], "country_join_key string, country_raw string"
    )
    staged = spark.createDataFrame([("BAR",)], "country_join_key string")
    assert [tuple(r) for r in lookup.stage_unknown(found, staged).collect()] == [("FOO", "Foo")]


def test_flagged_line_takes_an_earlier_price_and_keeps_its_flag(spark):
    rows = [
        ("H1", "SPAIN", 0, 10.0, 100.0), ("H2", "SPAIN", 1, 0.0, 5.0), ("H2", "ITALY", 1, 0.0, 5.0),
    ]
    lines = spark.createDataFrame(
        [("c", "i", key, "EUR", 2024, half, flag, n, amount) for half, key, flag, n, amount in rows],
        "company string, item_code string, _dest_key string, billing_currency string, _year int, "
        "_semester string, is_no_media int, quantity double, fx_transaction_lc double",
    )
    found = {
        (r["_dest_key"], r["_semester"]): (r["pm_omogeneo"], r["is_no_media"])
        for r in pricing.price_producers(lines).collect()
    }
    # Only usable lines may borrow a neighbouring country's price.
    assert found == {("SPAIN", "H1"): (10.0, 0), ("SPAIN", "H2"): (10.0, 1), ("ITALY", "H2"): (None, 1)}


def test_mapping_keys_agree_in_spark_and_python(spark):
    letters = [chr(c) for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000 and (chr(c).casefold() != chr(c) or chr(c).upper() != chr(c) or c < 0x250)]
    names = [f"x{c}y" for c in letters if c.strip()] + ["Größe", "GRÖSSE", "İstanbul ı"]
    given = [(n, f"t{mapping.field_key(n)}", "TEXT") for n in names]
    table = spark.createDataFrame(given, "original_field string, proposed_field string, data_types_found string")
    found = mapping.mapping_from_table(table, names)
    assert {mapping.field_key(n) for n in names} == set(found)
    assert all(target.name == f"t{key}" for key, target in found.items())


def test_spans_of_zero_cover_one_place(spark):
    schema = "file_id string, row_idx int, cell_idx int, colspan int, rowspan int, text string, num double"
    rows = [
        ("f", 1, 0, 1, 1, "a", 1.0), ("f", 1, 1, 0, 1, "b", 2.0), ("f", 1, 2, 1, 0, "c", 3.0),
        ("f", 2, 0, 1, 2, "d", 4.0), ("f", 2, 1, 0, 1, "e", 5.0), ("f", 2, 2, -1, None, "g", 6.0), ("f", 3, 0, None, 1, "h", 7.0),
    ]
    found = reports.span_expand(spark.createDataFrame(rows, schema)).select("row_idx", "col_idx", "text")
    assert sorted(map(tuple, found.collect())) == [
        (1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (2, 0, "d"), (2, 1, "e"), (2, 2, "g"), (3, 0, "d"), (3, 1, "h"),
    ]


def test_file_without_header_cells_fails(spark):
    cells = spark.createDataFrame([("f", 1, "ACT 24"), ("f", 2, "12"), ("g", 9, "x")], "file_id string, row_idx int, text string")
    with pytest.raises(Exception, match="No scenario row in file g"):
        reports.header_roles(cells).collect()
