"""Publishing by partition, reconciled loads, the batch ledger: reruns, refusals, crashes between the steps."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tradeloom.operators.joins import lookup_join, measured, proven_unique
from tradeloom.operators.quality import control_totals
from tradeloom.plans import products
from tradeloom.session import cut_lineage, intermediates, shared_folder, stored_bytes
from tradeloom.sources import publish, sinks
from tradeloom.sources.publish import ReconciliationError, load_reconciled, observed_write, publish_partitions, published
from tradeloom.streaming import ledger

ROWS = "batch_id string, quantity double, gross_sales double, line int"


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def _content(spark, target):
    return sorted((tuple(r) for r in published(spark, target, ROWS).select("batch_id", "quantity", "line").collect()), key=repr)


def _files(target):
    return {str(p): p.stat().st_mtime_ns for p in Path(target).rglob("*.parquet")}


def test_publish_touches_its_partitions_only(spark, tmp_path):
    target = str(tmp_path / "t")
    assert published(spark, target, ROWS).count() == 0
    assert publish_partitions(_rows(spark, ("a", 1.0, 1.0, 1), ("b", 2.0, 2.0, 1), (None, 3.0, 3.0, 1)), target, ["batch_id"]) == 3
    before = _files(target)
    renewed = _rows(spark, ("b", 5.0, 5.0, 1), ("b", 6.0, 6.0, 2), ("c", 7.0, 7.0, 1))
    for _ in range(2):  # a rerun gives the same table
        assert publish_partitions(renewed, target, ["batch_id"]) == 3
        assert _content(spark, target) == sorted(
            [("a", 1.0, 1), ("b", 5.0, 1), ("b", 6.0, 2), ("c", 7.0, 1), (None, 3.0, 1)], key=repr
        )
    kept = {f: t for f, t in before.items() if "batch_id=b" not in f}
    assert kept.items() <= _files(target).items() and len(kept) == 2
    assert publish_partitions(renewed.where("false"), target, ["batch_id"]) == 0
    assert len(_content(spark, target)) == 5


def test_publish_by_two_columns_can_read_its_own_target(spark, tmp_path):
    target = str(tmp_path / "t")
    publish_partitions(_rows(spark, ("a", 1.0, 1.0, 1), ("a", 2.0, 2.0, 2), ("b", 3.0, 3.0, 1)), target, ["batch_id", "line"])
    more = published(spark, target, ROWS).where("batch_id = 'a' AND line = 2").withColumn("quantity", F.col("quantity") * 10)
    publish_partitions(more, target, ["batch_id", "line"])
    assert _content(spark, target) == [("a", 1.0, 1), ("a", 20.0, 2), ("b", 3.0, 1)]


@pytest.mark.parametrize("fails_at", range(4))
def test_crash_between_the_steps_is_recovered(spark, tmp_path, monkeypatch, fails_at):
    """Whichever file operation of the swap dies, the table is the old one or, later, the new one as a whole."""
    target = str(tmp_path / "t")
    publish_partitions(_rows(spark, ("a", 1.0, 1.0, 1), ("b", 2.0, 2.0, 1)), target, ["batch_id"])
    steps = []

    def dying(original):
        def step(self, *names):
            if len(steps) == fails_at:
                raise KeyboardInterrupt
            steps.append(names)
            return original(self, *names)

        return step

    real = publish._Folder.delete, publish._Folder.move
    renewed = _rows(spark, ("a", 8.0, 8.0, 1), ("b", 9.0, 9.0, 1))
    with monkeypatch.context() as patch:
        patch.setattr(publish, "recover", lambda *_: None)
        patch.setattr(publish._Folder, "move", dying(real[1]))
        patch.setattr(publish._Folder, "delete", dying(real[0]))
        with pytest.raises(KeyboardInterrupt):
            publish_partitions(renewed, target, ["batch_id"])
    old, new = [("a", 1.0, 1), ("b", 2.0, 1)], [("a", 8.0, 1), ("b", 9.0, 1)]
    assert _content(spark, target) == (old if fails_at == 0 else new)
    assert not {"_staged", "_ready"} & set(os.listdir(target)) - {"_ready"} and not publish._Folder(spark, target).folders("_ready")
    publish_partitions(renewed, target, ["batch_id"])
    assert _content(spark, target) == new


def test_failing_check_discards_the_staged_rows(spark, tmp_path):
    target = str(tmp_path / "t")
    publish_partitions(_rows(spark, ("a", 1.0, 1.0, 1)), target, ["batch_id"])
    before = _files(target)

    def refuse(staged):
        assert staged.count() == 1
        raise ReconciliationError("no")

    with pytest.raises(ReconciliationError):
        publish_partitions(_rows(spark, ("a", 2.0, 2.0, 1)), target, ["batch_id"], refuse)
    assert _files(target) == before


def test_load_is_published_or_discarded(spark, tmp_path):
    target = str(tmp_path / "t")
    good = _rows(spark, ("a", 1.5, 10.0, 1), ("a", 2.5, 20.0, 2))
    for _ in range(2):
        assert load_reconciled(good, control_totals(good), target) == 2
    bad = _rows(spark, ("a", 1.5, 10.0, 1), ("b", None, 5.0, 1))
    read = _rows(spark, ("a", 1.5, 10.0, 1), ("b", 4.0, 5.0, 1))
    with pytest.raises(ReconciliationError, match="quantity: expected 5.5.*staged 1.5"):
        load_reconciled(bad, control_totals(read), target)
    with pytest.raises(ReconciliationError, match="row_count"):
        load_reconciled(read.limit(1), control_totals(read), target)
    assert _content(spark, target) == [("a", 1.5, 1), ("a", 2.5, 2)]


def test_observed_write_computes_the_rows_once(spark, tmp_path):
    computed = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    df = spark.range(1000).mapInArrow(touch, "id long")
    seen = observed_write(df, lambda rows: rows.write.parquet(str(tmp_path / "o")), total=F.sum("id"))
    assert seen == {"rows": 1000, "total": 499500} and computed.value == 1000
    empty = observed_write(df.where("id < 0"), lambda rows: rows.write.parquet(str(tmp_path / "e")))
    assert empty["rows"] == 0


def _registered(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "batch_id string")


def test_ledger_runs_only_what_is_pending(spark, tmp_path):
    book, target = str(tmp_path / "ledger"), str(tmp_path / "t")
    landing = _rows(spark, ("a", 1.0, 1.0, 1), ("b", 2.0, 2.0, 1), (None, 9.0, 9.0, 1))
    seen = []

    def harmonise(rows):
        seen.append(sorted(r["batch_id"] for r in rows.select("batch_id").distinct().collect()))
        return rows.withColumn("quantity", F.col("quantity") + 1)

    def run(*names):
        return ledger.run_pending(_registered(spark, *names), landing, harmonise, book, "harmonise", target)

    assert run("a", "z", None) == 2 and run("a", "z") == 0 and seen == [["a"]]
    assert run("a", "b", "z") == 1 and seen == [["a"], ["b"]]
    assert _content(spark, target) == [("a", 2.0, 1), ("b", 3.0, 1)]
    entries = {r["batch_id"]: r["rows"] for r in ledger.processed_batches(spark, book, "harmonise").collect()}
    assert entries == {"a": 1, "b": 1, "z": 0}
    other = ledger.pending_batches(_registered(spark, "a", "b"), book, "valorise")
    assert sorted(r["batch_id"] for r in other.collect()) == ["a", "b"]


def test_ledger_repeats_a_run_that_failed(spark, tmp_path, monkeypatch):
    book, target = str(tmp_path / "ledger"), str(tmp_path / "t")
    landing = _rows(spark, ("a", 1.0, 1.0, 1), ("b", 2.0, 2.0, 1))
    arguments = (_registered(spark, "a", "b"), landing, lambda rows: rows, book, "harmonise", target)
    with monkeypatch.context() as patch:  # published, but dead before the entry
        patch.setattr(ledger, "published", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ledger.run_pending(*arguments)
    assert ledger.run_pending(*arguments) == 2 and ledger.run_pending(*arguments) == 0
    assert _content(spark, target) == [("a", 1.0, 1), ("b", 2.0, 1)]


def _stored(spark):
    return {n for n in os.listdir(shared_folder(spark)) if n.startswith("tradeloom-")}


def test_intermediates_are_deleted_also_after_an_error(spark):
    before = _stored(spark)
    with intermediates(spark):
        outer = cut_lineage(spark.range(10))
        with intermediates(spark):
            cut_lineage(spark.range(5))
            measured(spark.range(3))
        assert outer.count() == 10 and len(_stored(spark) - before) == 1
    assert _stored(spark) == before
    with pytest.raises(RuntimeError), intermediates(spark):
        cut_lineage(spark.range(10))
        raise RuntimeError
    assert _stored(spark) == before


def test_broadcast_follows_stored_bytes(spark):
    long_rows = spark.range(2).select("id", F.expr("repeat(uuid(), 1000)").alias("name"))
    size = stored_bytes(cut_lineage(long_rows))
    assert size > 100
    plans = [measured(long_rows, limit)._jdf.queryExecution().logical().toString() for limit in (10 * size, 1)]
    assert "broadcast" in plans[0].lower() and "broadcast" not in plans[1].lower()


def test_repeated_lookup_key_fails_the_join(spark):
    facts = spark.createDataFrame([("a",), ("b",), (None,)], "code string")
    names = spark.createDataFrame([("a", "A"), ("b", "B"), (None, "none")], "key string, name string")
    found = lookup_join(facts, names, {"key": F.col("code")}, ["name"], null_safe=True, unique=False)
    assert sorted(map(tuple, found.collect()), key=repr) == [("a", "A"), ("b", "B"), (None, "none")]
    twice = names.unionByName(names.where("key = 'b'"))
    with pytest.raises(Exception, match='several rows: ."key":"b"'):
        lookup_join(facts, twice, {"key": F.col("code")}, ["name"], unique=False).collect()
    with pytest.raises(Exception, match="several rows"):
        proven_unique(names.unionByName(names.where("key IS NULL")), ["key"]).collect()


def test_validity_intervals_and_version_on_date(spark):
    rows = [
        (1, 1, "old", "2020-01-01", "2020-09-01"),  # runs on past its successor
        (1, 2, "mid", "2020-06-01", "2020-08-01"),  # then a gap
        (1, 3, "lost", "2021-01-01", None),
        (1, 4, "new", "2021-01-01", None),  # of one day the highest version
        (2, 1, "backwards", "2020-05-01", "2020-04-01"),
        (2, 2, "undated", None, None),
    ]
    given = spark.createDataFrame(rows, "id_prod int, version int, description string, valid_from string, valid_to string")
    dated = given.withColumns({c: F.to_date(c) for c in ("valid_from", "valid_to")})
    found = products.validity_intervals(dated)
    spans = [(r["description"], str(r["valid_from"]), str(r["valid_to"])) for r in found.orderBy("valid_from").collect()]
    assert spans == [("old", "2020-01-01", "2020-06-01"), ("mid", "2020-06-01", "2020-08-01"), ("new", "2021-01-01", "None")]
    days = ["2019-12-31", "2020-01-01", "2020-05-31", "2020-06-01", "2020-08-01", "2025-01-01", None]
    lines = spark.createDataFrame([("c", "i", d) for d in days], "company string, item_code string, day string")
    named = found.select(F.lit("c").alias("company"), F.lit("i").alias("item_code"), "description", "valid_from", "valid_to")
    held = products.version_on_date(lines, named, F.to_date(lines["day"]), ["description"])
    assert {r["day"]: r["description"] for r in held.collect()} == dict(zip(days, [None, "old", "old", "mid", None, "new", None]))


def test_hierarchy_leaves_gaps_null(spark):
    codes = spark.createDataFrame([(1, 1, 1), (2, 1, None), (3, 9, 1)], "id int, id_a int, id_b int")
    level = spark.createDataFrame([(1, "X", "ex")], "id int, code string, desc string")
    found = products.hierarchy(codes, [level, level], ["a", "b"])
    assert sorted(map(tuple, found.select("master_code_id", "a_code", "b_desc", "path").collect())) == [
        (1, "X", "ex", "X > X"), (2, "X", None, "X"), (3, None, "ex", "X")
    ]


def test_merge_reads_only_touched_partitions(spark):
    shape = "k int, period string, v int"
    spark.sql("drop table if exists merged")
    old = [(1, "p1", 1), (2, "p2", 2), (None, None, 3), (4, "p3", 4)]
    spark.createDataFrame(old, shape).write.partitionBy("period").saveAsTable("merged")
    new = spark.createDataFrame([(1, "p1", 9), (5, "p1", 5), (None, None, 9), (1, None, 6), (1, "p9", 7)], shape)
    fresh = sinks.insert_only(spark.table("merged"), new, ["k", "period"], ["period"])
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(period" in plan and "p9" in plan and "p2" not in plan
    for _ in range(2):  # again: nothing is new
        sinks.merge_table(new, "merged", ["k", "period"])
        found = sorted(((r["k"], r["period"], r["v"]) for r in spark.table("merged").collect()), key=repr)
        assert found == sorted([*old, (5, "p1", 5), (1, None, 6), (1, "p9", 7)], key=repr)
    assert {c.name for c in spark.catalog.listColumns("merged") if c.isPartition} == {"period"}
    empty = new.where("false")
    assert sinks.insert_only(spark.table("merged"), empty, ["k", "period"], ["period"]).isEmpty()
    limit, sinks.PRUNE_VALUES = sinks.PRUNE_VALUES, 1  # beyond the limit the join alone decides
    try:
        assert sinks.insert_only(spark.table("merged"), new, ["k", "period"], ["period"]).isEmpty()
    finally:
        sinks.PRUNE_VALUES = limit
        spark.sql("drop table merged")
