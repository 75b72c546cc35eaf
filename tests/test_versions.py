"""Published versions: whole or not at all, readers, conflicts, reruns, buckets, removal."""

from __future__ import annotations

import subprocess
import sys

import pytest
from conftest import ROOT
from pyspark.sql import functions as F

from skyledger.operators import audit, incremental
from skyledger.sources import tables
from skyledger.sources.versions import Conflict, Warehouse

SCHEMA = "k int, day string, v int"


@pytest.fixture()
def house(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "house"))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_nothing_is_visible_before_the_commit(spark, rows, house):
    with pytest.raises(ValueError):
        house.read("t")
    first = house.begin()
    first.replace("t", rows([(1, "a", 1)], SCHEMA))
    assert house.versions() == [] and first.read("t").count() == 1
    assert first.commit() == 1
    second = house.begin()
    second.replace("t", rows([(2, "b", 2)], SCHEMA))
    second.replace("u", rows([(3, "c", 3)], SCHEMA))
    assert rows_of(house.read("t")) == [(1, "a", 1)] and house.table("u") is None
    second.commit()
    assert rows_of(house.read("t")) == [(2, "b", 2)] and house.read("u").count() == 1


def test_a_job_killed_before_its_commit_leaves_the_old_table(spark, rows, house, tmp_path):
    """Another process writes its rows and dies; the table is as it was, and a rerun gives what the job was to give."""
    start = house.begin()
    start.replace("t", rows([(1, "a", 1), (2, "b", 1)], SCHEMA), ["day"])
    start.commit()
    job = f"""
import os, sys
sys.path.insert(0, {str(ROOT)!r})
from skyledger.session import local_session
from skyledger.sources.versions import Warehouse
spark = local_session(2, **{{"spark.checkpoint.dir": {str(tmp_path / "work")!r}}})
change = Warehouse(spark, {house.root!r}).begin()
change.replace_parts("t", spark.createDataFrame([(9, "b", 9)], {SCHEMA!r}), "day")
os._exit(9) if sys.argv[1] == "die" else change.commit("load")
"""
    for fate in ("die", "live"):
        subprocess.run([sys.executable, "-c", job, fate], timeout=240, capture_output=True)
        want = [(1, "a", 1), (2, "b", 1)] if fate == "die" else [(1, "a", 1), (9, "b", 9)]
        assert rows_of(house.read("t")) == want
    assert house.versions() == [1, 2]
    assert house.vacuum(keep=1, older_than=0) >= 1 and house.versions() == [2]
    assert rows_of(house.read("t")) == [(1, "a", 1), (9, "b", 9)]


def test_a_reader_keeps_its_version(spark, rows, house):
    for n in range(3):
        change = house.begin()
        change.replace("t", rows([(n, "a", n)], SCHEMA), ["day"])
        change.commit()
        if n == 0:
            early = house.read("t")
    assert rows_of(early) == [(0, "a", 0)] and rows_of(house.read("t", 2)) == [(1, "a", 1)]


def test_commits_in_between(spark, rows, house):
    start = house.begin()
    start.replace("t", rows([(1, "a", 1)], SCHEMA))
    start.replace("u", rows([(1, "a", 1)], SCHEMA))
    start.commit()
    one, two, three, four = (house.begin() for _ in range(4))
    one.append("t", rows([(2, "a", 1)], SCHEMA))
    two.append("t", rows([(3, "a", 1)], SCHEMA))
    three.replace("u", rows([(4, "a", 1)], SCHEMA))
    four.replace("t", rows([(5, "a", 1)], SCHEMA))
    assert [x.commit() for x in (one, two, three)] == [2, 3, 4]
    with pytest.raises(Conflict):
        four.commit()
    assert [r[0] for r in rows_of(house.read("t"))] == [1, 2, 3] and house.read("u").first().k == 4
    assert not house._create(f"{house.root}/_manifest/{4:010d}.json", "{}")


def test_a_label_is_committed_once(spark, rows, house):
    for _ in range(3):
        change = house.begin()
        change.append("t", rows([(1, "a", 1)], SCHEMA))
        change.commit("load 7")
    assert house.read("t").count() == 1 and house.versions() == [1] and house.holds("load 7")


def test_partitions_with_odd_names(spark, rows, house):
    data = [(1, "a/b=c%", 1), (2, None, 1), (3, "x y*[z]", 1), (4, "", 1), (5, "é", 1)]
    start = house.begin()
    start.replace("t", rows(data, SCHEMA), ["day"])
    start.commit()
    new = rows([(1, "é", 2), (2, "é", 2), (3, "x y*[z]", 3)], SCHEMA)
    want = rows_of(incremental.delete_insert(house.read("t"), new, "day", ["k"]).select("k", "day", "v"))
    change = house.begin()
    change.delete_insert("t", new, "day", ["k"])
    change.commit()
    assert rows_of(house.read("t")) == want
    assert house.read("t").where("day = 'é'").count() == 2


def test_ten_new_rows_rewrite_at_most_ten_of_64_buckets(spark, house):
    old = spark.range(20_000).selectExpr("id as k", "'old' as state", "id as v")
    change = house.begin()
    change.create("t", old.schema, ["k"], 64)
    change.merge("t", old, [])
    change.commit()
    before = set(house.table("t").folders)
    new = spark.createDataFrame([(k, "new", -1) for k in (*range(5), *range(90_000, 90_005))], "k bigint, state string, v bigint")
    change = house.begin()
    touched = change.merge("t", new, ["state"])
    change.commit()
    after = set(house.table("t").folders)
    assert len(touched) <= 10 and len(after - before) == len(before - after) == len(touched)
    got = {r.k: (r.state, r.v) for r in house.read("t").collect()}
    assert len(got) == 20_005 and got[3] == ("new", 3) and got[90_001] == ("new", -1) and got[7] == ("old", 7)
    plan = incremental.upsert(old, new, ["k"], ["state"])
    assert rows_of(plan) != [] and plan.count() == 20_005


def test_merge_and_slices_equal_their_plans(spark, rows, house):
    schema = "k int, f string, v int"
    old = rows([(1, "x", 1), (2, "x", 1), (3, "y", 1), (None, "z", 1)], schema)
    new = rows([(2, "n", 2), (2, "o", 3), (7, "n", 2), (None, "n", 2)], schema)
    order = [F.col("f").desc()]
    change = house.begin()
    for name, keys in (("t", ["k"]), ("once", ["k"]), ("s", ["f"])):
        change.create(name, old.schema, keys, 8)
    change.replace_keys("s", old.select("f"), old)
    change.merge("t", old, [])
    change.merge("once", old, [])
    change.commit()
    change = house.begin()
    change.merge("t", new, ["v"], order)
    change.merge("once", new, [], order, insert_only=True)
    change.replace_keys("s", rows([("x",), ("gone",)], "f string"), new)
    change.commit()
    assert rows_of(house.read("t")) == rows_of(incremental.upsert(old, new, ["k"], ["v"], order))
    assert rows_of(house.read("once")) == rows_of(old.unionByName(incremental.insert_missing(old, new, ["k"], order)))
    assert rows_of(house.read("s")) == rows_of(old.where("f <> 'x'").unionByName(new))
    compacted = house.begin()
    for name in ("t", "once", "s"):
        compacted.compact(name)
    compacted.commit()
    assert house.read("once").count() == 6 and len(house.table("once").folders) <= 8
    with pytest.raises(ValueError):
        house.begin().merge("absent", new, [])


def test_rows_and_audit_are_committed_together(spark, rows, house, monkeypatch):
    raw = rows([("f1", 1), ("f1", 2), ("f2", 3)], "file_path string, v int")

    def profiles(checksum):
        data = [("s", "raw/t", f, f"{checksum}-{f}", n, n, n, 0) for f, n in (("f1", 2), ("f2", 1))]
        return rows(data, "source_name string, target_table string, file_path string, checksum_md5 string, row_count bigint, source_rows bigint, valid_rows bigint, quarantined_rows bigint")

    audit.load_files(house, "raw/t", raw, profiles("a"), "run-1")
    lost = house.begin()
    monkeypatch.setattr(type(lost), "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        audit.load_files(house, "raw/t", raw.where("v > 1"), profiles("b"), "run-2")
    assert house.read("raw/t").count() == 3 and house.read(audit.AUDIT_TABLE).count() == 2
    monkeypatch.undo()
    for _ in range(2):
        audit.load_files(house, "raw/t", raw.where("v > 1"), profiles("b"), "run-2")
    assert rows_of(house.read("raw/t")) == [("f1", 2), ("f2", 3)] and house.read(audit.AUDIT_TABLE).count() == 4


def test_append_with_a_label_is_safe_on_a_rerun(spark, rows, tmp_path):
    one = rows([(1, "a", 1)], SCHEMA)
    for label in ("x", "x", "y", None):
        tables.write_table(one, str(tmp_path), "mart", "t", mode="append", label=label)
    assert tables.read_table(spark, str(tmp_path), "mart", "t").count() == 3
