"""Restarts, refreshes and replays of the streams: every file and row exactly once."""

import pytest

from tradeloom.streaming import resubmissions
from tradeloom.streaming.files import register_files

SENT = "company string, month int, version int, amount double"


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in (1, 2, 3):
        (folder / f"company_{i}_a.csv").write_bytes(b"x")
    return folder


def _registered(df):
    return sorted((r["file_name"], r["batch_id"]) for r in df.collect())


def _names(batch, *numbers):
    return [(f"company_{i}_a.csv", batch) for i in numbers]


def test_refresh_then_normal_run(spark, inbox, tmp_path):
    table, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    assert _registered(register_files(spark, str(inbox), "b1", table, checkpoint)) == _names("b1", 1, 2, 3)
    (inbox / "company_4_a.csv").write_bytes(b"x")
    again = register_files(spark, str(inbox), "b2", table, checkpoint, full_refresh=True, maxFilesPerTrigger="1")
    assert _registered(again) == _names("b2", 1, 2, 3, 4)
    assert _registered(register_files(spark, str(inbox), "b3", table, checkpoint)) == _names("b2", 1, 2, 3, 4)
    (inbox / "company_5_a.csv").write_bytes(b"x")
    later = register_files(spark, str(inbox), "b4", table, checkpoint)
    assert _registered(later) == _names("b2", 1, 2, 3, 4) + _names("b4", 5)


def test_two_refreshes_with_one_batch_id(spark, inbox, tmp_path):
    table, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    for _ in range(2):
        found = register_files(spark, str(inbox), "b1", table, checkpoint, full_refresh=True)
        assert _registered(found) == _names("b1", 1, 2, 3)


def test_registry_without_files_and_foreign_checkpoint(spark, tmp_path):
    (tmp_path / "in").mkdir()
    table = str(tmp_path / "t")
    assert register_files(spark, str(tmp_path / "in"), "b1", table, str(tmp_path / "c")).count() == 0
    with pytest.raises(ValueError, match="no checkpoint"):
        register_files(spark, str(tmp_path / "in"), "b1", table, str(tmp_path / "other"))


def _send(spark, folder, rows):
    spark.createDataFrame(rows, SENT).coalesce(1).write.mode("append").parquet(str(folder))


def _apply(spark, tmp_path, checkpoint="c"):
    stream = spark.readStream.schema(SENT).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "sent"))
    keys = ["company", "month"]
    found = resubmissions.apply_resubmissions(stream, str(tmp_path / "t"), str(tmp_path / checkpoint), keys, "version")
    return sorted(map(tuple, found.collect()), key=str)


def test_resubmission_replaces_its_key_only(spark, tmp_path):
    _send(spark, tmp_path / "sent", [("a", 1, 1, 1.0), ("a", 1, 1, 1.0), ("", 1, 1, 2.0), (None, 1, 1, 3.0)])
    assert len(_apply(spark, tmp_path)) == 4
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "current").rglob("part-*.parquet")}
    _send(spark, tmp_path / "sent", [("a", 1, 2, 9.0)])
    expected = sorted([("a", 1, 2, 9.0), ("", 1, 1, 2.0), (None, 1, 1, 3.0)], key=str)
    assert _apply(spark, tmp_path) == expected
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "current").rglob("part-*.parquet")}
    assert len(before.items() & after.items()) == len(before) - 1  # other buckets keep their files
    assert _apply(spark, tmp_path) == expected


def test_replayed_epoch_lands_once(spark, tmp_path, monkeypatch):
    _send(spark, tmp_path / "sent", [("a", 1, 1, 1.0), ("b", 1, 1, 2.0)])
    land = resubmissions.land_batch

    def break_off(batch, folder):
        land(batch, folder)
        raise RuntimeError("lost")

    monkeypatch.setattr(resubmissions, "land_batch", break_off)
    with pytest.raises(Exception, match="lost"):
        _apply(spark, tmp_path)
    monkeypatch.setattr(resubmissions, "land_batch", land)
    assert _apply(spark, tmp_path) == [("a", 1, 1, 1.0), ("b", 1, 1, 2.0)]


def test_target_refuses_another_checkpoint(spark, tmp_path):
    _send(spark, tmp_path / "sent", [("a", 1, 1, 1.0)])
    _apply(spark, tmp_path)
    with pytest.raises(ValueError, match="another checkpoint"):
        _apply(spark, tmp_path, "other")


def test_refresh_reads_no_earlier_epoch(spark, tmp_path):
    _send(spark, tmp_path / "sent", [("a", 1, 1, 1.0), ("b", 1, 1, 2.0)])
    _apply(spark, tmp_path)
    for part in (tmp_path / "t" / "log").rglob("part-*.parquet"):
        part.write_bytes(b"unreadable")  # whoever opens history again fails
        (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    _send(spark, tmp_path / "sent", [("a", 1, 2, 5.0), ("c", 1, 1, 3.0)])
    assert _apply(spark, tmp_path) == [("a", 1, 2, 5.0), ("b", 1, 1, 2.0), ("c", 1, 1, 3.0)]


def test_refresh_that_was_not_recorded_is_repeated(spark, tmp_path, monkeypatch):
    _send(spark, tmp_path / "sent", [("a", 1, 1, 1.0), ("b", 1, 1, 2.0)])
    _apply(spark, tmp_path)
    _send(spark, tmp_path / "sent", [("a", 1, 1, 4.0), ("b", 1, 2, 5.0)])  # a second part of a version, and a new one
    publish = resubmissions.publish_partitions

    def break_off(*arguments):
        publish(*arguments)
        raise RuntimeError("lost")

    monkeypatch.setattr(resubmissions, "publish_partitions", break_off)
    with pytest.raises(RuntimeError, match="lost"):
        _apply(spark, tmp_path)
    monkeypatch.setattr(resubmissions, "publish_partitions", publish)
    expected = [("a", 1, 1, 1.0), ("a", 1, 1, 4.0), ("b", 1, 2, 5.0)]
    assert _apply(spark, tmp_path) == expected and _apply(spark, tmp_path) == expected


def test_buckets_grow_with_the_rows(spark, tmp_path):
    rows = [(f"c{i}", 1, 1, float(i)) for i in range(40)]
    _send(spark, tmp_path / "sent", rows)
    stream = spark.readStream.schema(SENT).parquet(str(tmp_path / "sent"))
    target, keys = str(tmp_path / "t"), ["company", "month"]
    resubmissions.append_submissions(stream, target, str(tmp_path / "c"), keys, buckets=2)
    resubmissions.refresh_current(spark, target, stream.schema, keys, "version", rows_per_bucket=5)
    assert [p.name for p in (tmp_path / "t" / "current").iterdir()] == ["8"]
    _send(spark, tmp_path / "sent", [("c3", 1, 2, 9.0)])
    resubmissions.append_submissions(stream, target, str(tmp_path / "c"), keys)
    resubmissions.refresh_current(spark, target, stream.schema, keys, "version", rows_per_bucket=5)
    found = sorted(map(tuple, resubmissions.current_submissions(spark, target, stream.schema).collect()))
    assert found == sorted([r for r in rows if r[0] != "c3"] + [("c3", 1, 2, 9.0)])
