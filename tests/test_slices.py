"""Queries that work through their lines in slices, and what stays on disk after a stored table."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from tradeloom.session import SHUFFLE_CLEANUP, cut_lineage, in_slice, in_slices
from verification import registry
from verification.catalog import QUERIES

SLICED = [
    "harmonized",
    "coverage_summary",
    "matrix_to_long",
    "matrix_landing",
    "hierarchy_leaves",
    "product_classify",
    "dim_product_master",
    "product_version_on_date",
    "span_expand",
]


def _shuffle_files(spark):
    top = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in top for _, _, names in os.walk(folder) for f in names if f.startswith("shuffle_")}


def _shared_tables(spark):
    return {n for n in os.listdir(spark.conf.get("spark.checkpoint.dir")) if n.startswith("tradeloom-")}


def test_stored_tables_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert cut_lineage(counted).count() == 7
    stored = {f for f in _shuffle_files(spark) - before if f.endswith(".data")}
    assert len(stored) <= 4  # those of count()
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    assert counted.count() == counted.count() == 7


def test_slices_hold_every_row_once_and_keep_only_the_result(spark):
    rows = spark.range(100).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("k"))
    before = _shared_tables(spark)
    seen = []

    def build(number, stored):
        seen.append(len(_shared_tables(spark) - before))
        return cut_lineage(stored.where(in_slice(F.col("k"), number, 3)).groupBy("k").count())

    found = in_slices(spark, 3, build, lambda: (cut_lineage(rows),))
    assert sorted((r["k"] or 0, r["count"]) for r in found.collect()) == [(k, 20) for k in range(5)]
    assert seen == [1, 2, 2]  # what was prepared, and the result once it has a slice
    assert len(_shared_tables(spark) - before) == 1


def test_a_failed_slice_leaves_only_what_was_stored(spark):
    before = _shared_tables(spark)

    def build(number, stored):
        if number:
            raise RuntimeError
        return stored

    with pytest.raises(RuntimeError):
        in_slices(spark, 2, build, lambda: (cut_lineage(spark.range(3)),))
    assert len(_shared_tables(spark) - before) == 1


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of a few orders; a supplier has no name, two have one name, some lines come twice, some have no part."""
    path = tmp_path_factory.mktemp("tables")
    day = datetime.datetime(1996, 1, 1)

    def put(name, schema, found):
        spark.createDataFrame(found, schema).coalesce(1).write.parquet(f"{path}/{name}.parquet")

    put("nation", "n_nationkey int, n_name string, n_regionkey int", [(k, f"NATION_{k}", k % 5) for k in range(25)])
    segments = ("BUILDING", "FURNITURE", "AUTOMOBILE", "HOUSEHOLD", "MACHINERY")
    put(
        "customer",
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        [(k, f"Customer#{k:09d}", k % 6, 1.0, segments[k % 5]) for k in range(12)],
    )
    names = [None, "Company_045", "COMPANY_GROUP_002", *[f"Supplier#{k}" for k in range(3, 6)], "Supplier#5"]
    put(
        "supplier",
        "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
        [(k, name, k % 3, 5.0) for k, name in enumerate(names)],
    )
    types = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    put(
        "part",
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        [(k, f"hot {('bolt', 'ring', 'gear')[k % 3]}", f"Brand#{k % 4}", types[k % 6], k % 9, 9.0 + k) for k in range(15)],
    )
    put(
        "orders",
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
        "o_orderpriority string",
        [(k, k % 12, "O", 10.0 * k, day + datetime.timedelta(40 * k), ("1-URGENT", "5-LOW")[k % 2]) for k in range(40)],
    )
    lines = [
        (
            k % 40, None if k % 31 == 30 else k % 15, k * 3 % 7, k % 7 + 1, float(k % 9 + 1), 100.0 + k, 0.25, 0.5,
            "NAR"[k % 3], "OF"[k % 2], day + datetime.timedelta(11 * k),
        )
        for k in range(160)
    ]
    put(
        "lineitem",
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        lines + lines[:9],
    )
    return str(path)


def _rows(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", SLICED)
def test_slices_of_a_query_give_what_one_gives(spark, folder, monkeypatch, name):
    whole = _rows(QUERIES[name].run(spark, folder))
    size = os.path.getsize(max((f"{folder}/lineitem.parquet/{n}" for n in os.listdir(f"{folder}/lineitem.parquet")), key=os.path.getsize))
    monkeypatch.setattr(registry, "SLICE_BYTES", size // 2 + 1)
    before = _shared_tables(spark)
    sliced = QUERIES[name].run(spark, folder)
    assert "Exchange" not in sliced._jdf.queryExecution().executedPlan().toString()  # read from slices
    assert len(_shared_tables(spark) - before) == 1
    assert _rows(sliced) == whole and whole
