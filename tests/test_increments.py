"""Incremental runs over files that are added, changed, moved and removed."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from orrery.plans import increments

SCHEMA = "id int, day string, v string"


@pytest.fixture()
def folders(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    calls = []

    def put(name, *rows):
        path = source / name
        shutil.rmtree(path, ignore_errors=True)
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.parquet(str(path))

    def build(df):
        calls.append(sorted({r[0] for r in df.select(increments.DAY).distinct().collect()}))
        return df.where("v <> 'bad'").withColumn("v", F.upper("v"))

    def run():
        read = increments.parquet_files(spark, SCHEMA)
        return increments.run_increment(spark, str(source), str(target), read, F.try_to_timestamp("day"), build)

    def out():
        return sorted(tuple(r) for r in spark.read.parquet(str(target)).select("id", "v").collect())

    return source, target, put, run, out, calls


def stamps(target):
    return {p: os.stat(p).st_mtime_ns for p in map(str, target.rglob("part-*")) if "_manifest" not in p}


def test_only_changed_days_are_written(folders):
    source, target, put, run, out, calls = folders
    put("a", (1, "2024-01-01", "x"), (2, "2024-01-02", "y"))
    put("b", (3, "2024-01-02", "z"), (4, "no day", "w"))
    first = run()
    assert first == increments.Increment(2, ("2024-01-01", "2024-01-02", "none"), ())
    assert out() == [(1, "X"), (2, "Y"), (3, "Z"), (4, "W")]

    before = stamps(target)
    assert run() == increments.Increment(0, (), ()) and stamps(target) == before and len(calls) == 1

    put("b", (3, "2024-01-02", "changed"), (4, "no day", "w"))
    assert run() == increments.Increment(1, ("2024-01-02",), ())
    assert out() == [(1, "X"), (2, "Y"), (3, "CHANGED"), (4, "W")]
    kept = {p for p, t in stamps(target).items() if before.get(p) == t}
    assert {p.split("load_day=")[1][:10].split("/")[0] for p in kept} == {"2024-01-01", "none"}

    put("c", (5, "2024-01-03", "new"))
    assert run() == increments.Increment(1, ("2024-01-03",), ())
    assert len(out()) == 5


def test_moved_and_merged_files_change_no_day(folders):
    source, target, put, run, out, calls = folders
    put("a", (1, "2024-01-01", "x"), (2, "2024-01-02", "y"))
    put("b", (3, "2024-01-02", "z"), (3, "2024-01-02", "z"))
    run()
    before = stamps(target)
    shutil.rmtree(source / "b")
    put("a", (3, "2024-01-02", "z"), (2, "2024-01-02", "y"), (1, "2024-01-01", "x"), (3, "2024-01-02", "z"))
    assert run() == increments.Increment(1, (), ()) and stamps(target) == before
    assert run() == increments.Increment(0, (), ())
    put("a", (3, "2024-01-02", "z"), (2, "2024-01-02", "y"), (1, "2024-01-01", "x"))  # one copy less
    assert run().days_written == ("2024-01-02",) and len(out()) == 3


def test_days_that_go(folders):
    source, target, put, run, out, calls = folders
    put("a", (1, "2024-01-01", "x"))
    put("b", (2, "2024-01-02", "y"), (3, "2024-01-03", "z"))
    run()
    put("b", (2, "2024-01-02", "y"))
    assert run() == increments.Increment(1, (), ("2024-01-03",))
    assert out() == [(1, "X"), (2, "Y")]
    shutil.rmtree(source / "b")
    assert run() == increments.Increment(0, (), ("2024-01-02",))
    put("a", (1, "2024-01-01", "bad"))  # nothing is built for this day
    put("e")
    assert run().days_written == ("2024-01-01",) and not (target / "load_day=2024-01-01").exists()
    assert run() == increments.Increment(0, (), ())


def test_a_run_that_died_is_repeated(folders, monkeypatch):
    source, target, put, run, out, calls = folders
    put("a", (1, "2024-01-01", "x"))
    run()
    put("a", (1, "2024-01-01", "y"))
    with monkeypatch.context() as broken:
        broken.setattr(increments.Manifests, "publish", lambda self, new: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            run()
    assert run().days_written == ("2024-01-01",) and out() == [(1, "Y")]
    assert run() == increments.Increment(0, (), ())
    assert len(list((target / "_manifest").iterdir())) == 1


def test_increments_equal_a_full_run(spark, folders, tmp_path):
    source, target, put, run, out, calls = folders
    for n in range(4):
        for name in "abc":
            put(name, *((k, f"2024-01-{1 + (k * 7 + n) % 5:02d}", f"{name}{k % (n + 2)}") for k in range(30)))
        run()
    whole = tmp_path / "whole"
    read = increments.parquet_files(spark, SCHEMA)
    increments.run_increment(spark, str(source), str(whole), read, F.try_to_timestamp("day"), lambda df: df.where("v <> 'bad'").withColumn("v", F.upper("v")))
    both = [sorted(map(tuple, spark.read.parquet(str(p)).collect())) for p in (target, whole)]
    assert both[0] == both[1] and len(both[0]) == 90
