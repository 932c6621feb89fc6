import datetime

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import classify, quality
from tradeloom.plans import marts, reference
from tradeloom.sources import mapping
from tradeloom.streaming.files import register_files
from verification.catalog import QUERIES

D = datetime.date
SAMPLE = (
    "date date, company string, item_code string, customer string, channel string, "
    "destination_country string, quantity double, local_currency string, "
    "sales_local_currency double, submission_id long"
)
SAMPLE_ROWS = [
    (D(2025, 7, 1), "COMPANY_011", "SKU-001", "C1", "Wholesale", "Italy", 12.0, "EUR", 1200.0, 1),
    (D(2025, 7, 1), "COMPANY_011", "SKU-001", "C1", "Wholesale", "Italy", 13.0, "EUR", 1300.0, 2),
    (D(2025, 8, 1), "COMPANY_027", "SKU-002", "C2", "Retail", "Spain", 8.0, "EUR", 920.0, 1),
    (D(2025, 9, 1), "COMPANY_039", "SKU-003", "C3", "Retail", "France", 15.0, "EUR", 1725.0, 1),
]


def test_newest_submission_is_published(spark):
    curated = marts.curate(spark.createDataFrame(SAMPLE_ROWS, SAMPLE))
    found = {r["company"]: r for r in curated.collect()}
    assert len(found) == curated.count() == 3
    july = found["COMPANY_011"]
    assert (july["submission_id"], july["quantity"], july["sales_per_unit"], july["semester"]) == (
        2, 13.0, 100.0, "H2",
    )
    checks = quality.gold_checks(curated)
    assert checks.count() == 6
    quality.require_passed(checks)


def test_failed_gate_raises(spark):
    bad = spark.createDataFrame([(*SAMPLE_ROWS[0][:6], -1.0, *SAMPLE_ROWS[0][7:])], SAMPLE)
    with pytest.raises(ValueError, match="quantity_non_negative"):
        quality.require_passed(quality.gold_checks(marts.curate(bad)))
    with pytest.raises(Exception, match="breaks a table constraint"):
        quality.enforce_constraints(bad).collect()


def test_growth_uses_the_previous_month_on_record(spark):
    def row(month, sales):
        return (D(2025, month, 1), "A", "i", "c", "x", "It", 1.0, "EUR", sales, 1)

    df = spark.createDataFrame([row(1, 100.0), row(4, 150.0), row(5, 0.0), row(6, 10.0)], SAMPLE)
    out = marts.company_kpi(marts.curate(df)).orderBy("reporting_month").collect()
    assert [r["sales_growth_pct"] for r in out] == [None, 50.0, -100.0, None]


def test_kpis_adapt_to_missing_columns(spark):
    df = marts.curate(
        spark.createDataFrame([(D(2025, 1, 1), "A", 1.0, 5.0, 1)], "date date, company string, quantity double, sales double, submission_id long")
    )
    row = marts.company_kpi(df).first()
    assert (row["currency"], row["total_sales"], row["active_products"]) == ("N/A", 5.0, 0)
    with pytest.raises(ValueError):
        marts.product_kpi(df)


MAPPING = [("Year", "year", "INT"), ("Q", "quarter", "VARCHAR"), ("qty", "quantity", "DOUBLE"),
           ("sales", "gross_sales", "DOUBLE")]


def test_conflicting_or_unknown_mappings_fail():
    with pytest.raises(ValueError, match="Conflicting"):
        mapping.read_mapping([("A b", "x", "INT"), ("a_B", "y", "INT")])
    with pytest.raises(ValueError, match="Unsupported"):
        mapping.read_mapping([("A", "x", "BLOB")])
    assert mapping.read_mapping([("A", "x", "INT"), ("a", "x", " int ")]) == {"a": ("x", "int")}


def test_import_places_lineage_and_fails_without_a_date(spark):
    df = spark.createDataFrame([("2024", "Q3", "2", "9.5")], "Year string, Q string, Qty string, Sales string")
    out = mapping.import_mapped(df, mapping.read_mapping(MAPPING), "f.parquet")
    assert out.columns == ["date", "time_frames", "volumes", "quantity", "gross_sales", "data_matrix",
                           "data_collection", "project", "file_name"]
    row = out.first()
    assert (row["date"], row["time_frames"], row["quantity"]) == (D(2024, 7, 1), "quarter", 2.0)
    undated = spark.createDataFrame([("n/a", "Q3", "2", "9.5")], df.schema)
    with pytest.raises(Exception, match="without a readable date"):
        mapping.import_mapped(undated, mapping.read_mapping(MAPPING), "f").collect()
    with pytest.raises(ValueError, match="No mapping"):
        mapping.import_mapped(df.withColumn("x", F.lit(1)), mapping.read_mapping(MAPPING), "f")


def test_first_quote_wins_even_if_invalid_unless_asked(spark):
    rates = spark.createDataFrame(
        [(1, 202401, 1, 2, "abc"), (2, 202401, 1, 2, "1,25"), (3, 2024, 1, 2, "9")],
        "id int, id_time int, id_currency_base int, id_currency_target int, exchange_rate string",
    )
    currencies = spark.createDataFrame([(1, " gbp"), (2, "EUR")], "id int, currency_code string")
    times = spark.createDataFrame(
        [(202401, 2024, 1, 1, 1, 4), (2024, 2024, None, None, None, 1)],
        "id int, year int, semester int, quarter int, month int, id_time_frame int",
    )
    first = reference.exchange_rates(rates, currencies, times).collect()
    assert [(r["id_exchange_rate"], r["exchange_rate"]) for r in first] == [(1, None)]
    valid = reference.exchange_rates(rates, currencies, times, prefer_valid=True).collect()
    assert [(r["currency_base"], r["exchange_rate"]) for r in valid] == [("GBP", 1.25)]


def test_group_companies_find_their_products(spark):
    attributes = {a: F.lit(None).cast("string") for a in classify.PRODUCT_ATTRIBUTES}
    master = spark.createDataFrame(
        [("company_group_002", "x", "Thing")], "company string, item_code string, description string"
    ).withColumns(attributes)
    df = spark.createDataFrame(
        [("Company_045", " X", "thing "), ("company_045", "x", "Other"), ("company_045", "y", "t")],
        "company string, item_code string, item_description string",
    )
    out = classify.classify_product(df, master)
    assert [r["classification_status"] for r in out.orderBy("item_description").collect()] == [
        "Description Changed", "New", "Matched",
    ]


def test_control_totals_are_exact(spark):
    df = spark.createDataFrame([(0.1, 0.2)] * 10, "quantity double, gross_sales double")
    row = quality.control_totals(df).first()
    assert (str(row["quantity"]), str(row["gross_sales"])) == ("1.000000000000", "2.000000000000")


def test_registry_adds_only_new_files(spark, tmp_path):
    inbox, table, checkpoint = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "c")
    inbox.mkdir()
    (inbox / "company_011_italy_2025_q1.xlsx").write_bytes(b"abc")
    first = register_files(spark, str(inbox), "b1", table, checkpoint)
    assert [(r["company_name"], r["file_size"], r["file_extension"]) for r in first.collect()] == [
        ("company_011", 3, "xlsx")
    ]
    (inbox / "company_027_spain_2025_q1.xlsx").write_bytes(b"abcd")
    again = register_files(spark, str(inbox), "b2", table, checkpoint)
    assert sorted((r["batch_id"], r["company_name"]) for r in again.collect()) == [
        ("b1", "company_011"), ("b2", "company_027"),
    ]


@pytest.mark.parametrize("name", ["company_kpi", "fx_inverse", "matrix_to_long", "new_reference_rows"])
def test_registered_query_matches_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from verification import views
    from verification.check import compare

    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    for table in views.TABLES:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    state, note = compare(spark, connection, folder, name)
    assert state == "ok", note


def test_every_query_has_sql():
    assert [name for name, q in QUERIES.items() if q.oracle() is None] == []
