import pytest
from pyspark.sql import functions as F

from sparkwarden.operators import collections as C
from sparkwarden.operators import points

SCHEMA = "point_id bigint, vector array<float>, payload struct<name:string>"


def rows(spark, ids, name="a", dim=3):
    return spark.createDataFrame([(i, [float(i)] * dim, (name,)) for i in ids], SCHEMA)


def held(df):
    return {r.point_id: r.payload.name for r in df.collect()}


@pytest.fixture
def stored(spark, tmp_path):
    made = C.Collection(spark, str(tmp_path), "c")
    made.create(3, rows(spark, []).schema, buckets=4)
    return made


def test_versions_stay_readable(spark, stored):
    first = stored.upsert(rows(spark, range(10)))
    second = stored.upsert(rows(spark, [3, 4, 50], "b"))
    assert (first.number, second.number, stored.versions()) == (2, 3, [1, 2, 3])
    assert held(stored.read(1)) == {} and held(stored.read(2)) == dict.fromkeys(range(10), "a")
    assert held(stored.read()) == {**dict.fromkeys(range(10), "a"), 3: "b", 4: "b", 50: "b"}
    assert held(stored.retrieve([3, 9, 77])) == {3: "b", 9: "a"}
    third = stored.delete(rows(spark, [3, 99]))
    assert held(stored.read(third.number)).keys() == {*range(10), 50} - {3} and len(held(stored.read(3))) == 11


def test_only_touched_buckets_are_written(spark, stored):
    before = stored.upsert(rows(spark, range(100)))
    after = stored.upsert(rows(spark, [7], "b"))
    changed = [b for b in before.folders if before.folders[b] != after.folders[b]]
    assert len(before.folders) == 4 and len(changed) == 1
    assert stored.upsert(rows(spark, [])) == after and stored.delete(rows(spark, [])) == after


def test_create_if_absent_checks_the_length(spark, stored):
    assert stored.create(3, stored.version().schema).number == 1
    with pytest.raises(ValueError, match="3 entries, expected 4"):
        stored.create(4, stored.version().schema)


@pytest.mark.parametrize("bad", ["length", "null", "id", "job"])
def test_failed_writes_leave_no_trace(spark, stored, bad):
    now = stored.upsert(rows(spark, range(5)))
    fresh = rows(spark, [1, 8], "bad")
    if bad == "length":
        fresh = fresh.unionByName(rows(spark, [9], dim=2))
    elif bad == "null":
        fresh = fresh.withColumn("vector", F.when(F.col("point_id") == 1, F.col("vector")))
    elif bad == "id":
        fresh = fresh.withColumn("point_id", F.when(F.col("point_id") == 1, 1))
    else:
        fresh = fresh.withColumn("vector", F.transform("vector", lambda x: F.when(F.col("point_id") == 8, F.raise_error(F.lit("stopped")).cast("float")).otherwise(x)))
    with pytest.raises(Exception, match="stopped|expected 3|no id"):
        stored.upsert(fresh)
    assert stored.version() == now and held(stored.read()) == dict.fromkeys(range(5), "a")
    assert stored.vacuum(keep=9) == 0


def test_two_writers_cannot_make_one_version(spark, stored):
    now = stored.version()
    stored.upsert(rows(spark, [1], "first"))
    with pytest.raises(C.Conflict):
        stored._written(now, rows(spark, [2], "second"), {})
    assert held(stored.read()) == {1: "first"} and stored.vacuum(keep=9) == 0


def test_crash_before_the_pointer_is_not_seen(spark, stored, monkeypatch):
    now = stored.upsert(rows(spark, [1]))
    monkeypatch.setattr(C.Collection, "_commit", lambda self, made: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        stored.upsert(rows(spark, [2]))
    monkeypatch.undo()
    assert stored.version() == now and stored.upsert(rows(spark, [2])).number == now.number + 1


def test_repeated_ids_and_vacuum(spark, stored):
    both = rows(spark, [1, 2], "x").unionByName(rows(spark, [1], "y"))
    assert {held(stored.upsert(df) and stored.read())[1] for df in (both, both.orderBy(F.desc("payload")))} <= {"x", "y"}
    assert len(held(stored.read())) == 2
    stored.upsert(rows(spark, range(20), "z"))
    assert stored.vacuum() >= 1 and len(stored.versions()) == 1 and held(stored.read()) == dict.fromkeys(range(20), "z")
    with pytest.raises(FileNotFoundError):
        stored.read(1)


def test_saved_collection_refuses_other_columns(spark, tmp_path):
    points.save_collection(rows(spark, range(3)), str(tmp_path), "s", 3)
    with pytest.raises(ValueError, match="other columns"):
        points.save_collection(rows(spark, range(3)).drop("payload"), str(tmp_path), "s", 3)
    assert points.load_collection(spark, str(tmp_path), "s").count() == 3
