"""Files: reading, numbering over many blocks, profiling."""

from __future__ import annotations

import csv
import random

import duckdb
from conftest import plan_of
from pyspark.sql import functions as F

from skyledger.sources import files, tables


def test_csv_text_bom_quotes_and_empty(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿id,note\n1,"a ""quoted"", comma"\n2,\n3,""\n4, padded \n'.encode())
    got = [tuple(r) for r in files.read_csv(spark, str(tmp_path), ["id", "note"]).collect()]
    assert got == [("1", 'a "quoted", comma'), ("2", None), ("3", None), ("4", " padded ")]


def test_written_csv_reads_back_unchanged(spark, rows, tmp_path):
    data = [("1", ' pad "q", x '), ("2", "back\\slash"), ("3", "tab\tend")]
    files.write_csv(rows(data, "id string, note string"), str(tmp_path / "out"))
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "out"), ["id", "note"]).collect())) == data


def test_record_numbers_over_many_blocks(spark, tmp_path):
    sizes = {"a.csv": 5000, "b.csv": 1, "c.csv": 12000, "d.csv": 0}
    for name, n in sizes.items():
        body = "".join(f"{name}-{i},{'x' * (i % 50)}\n" for i in range(2, n + 2))
        (tmp_path / name).write_text("id,pad\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = files.with_row_number(files.read_csv_lines(spark, str(tmp_path), ["id", "pad"]))
        got = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == sum(sizes.values())
    assert all(r.row_number == int(r.id.split("-")[1]) for r in got)


def _csv_text(rnd, quoted_breaks: bool) -> str:
    """A file with quoted commas, doubled and stray quotes, blank lines, both line ends and quoted line breaks."""
    parts = ["a", "b c", "", "é", ",", '""', "x" * 30] + (["\n", "\r\n", "\n\n", '\n""', ',"" '] if quoted_breaks else [])
    loose = ["a", "", "5in", 'b"c', 'd"', " e", "é" * 20]
    out = ['id,"no, te",last']
    for i in range(rnd.randint(0, 40)):
        cells = [str(i)]
        for _ in range(rnd.randint(1, 3)):
            quoted = '"' + "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 4))) + '"'
            cells.append(rnd.choice([quoted, quoted + rnd.choice(["", "z", 'z"']), rnd.choice(loose)]))
        out.append(",".join(cells))
        out += [""] * (rnd.random() < 0.1)
    return "".join(line + rnd.choice(["\n", "\r\n"]) for line in out)


def test_records_are_those_of_a_csv_reader_at_any_split(spark, tmp_path):
    """Many files, cut every few dozen bytes, so that most blocks begin inside quotes; with and without quoted breaks."""
    rnd, want = random.Random(7), []
    for n in range(40):
        text = _csv_text(rnd, n % 4 > 0)
        (tmp_path / f"f{n}.csv").write_bytes((("\ufeff" if n % 5 == 0 else "") + text).encode())
        with (tmp_path / f"f{n}.csv").open(encoding="utf-8-sig", newline="") as handle:
            for number, row in enumerate(csv.DictReader(handle), start=2):
                want.append((f"f{n}.csv", number, row["id"] or None, row["no, te"] or None, row["last"] or None))
    (tmp_path / "none.csv").write_text("")
    for size in ("37", "100000"):
        cut = spark.newSession()
        cut.conf.set("spark.sql.files.maxPartitionBytes", size)
        cut.conf.set("spark.sql.files.openCostInBytes", "1")
        found = files.split_records(cut, str(tmp_path))
        assert size == "100000" or cut.read.text(str(tmp_path)).rdd.getNumPartitions() > 40
        assert found.where("number = 1").count() == 40
        rows = files.read_csv(cut, str(tmp_path / "f*.csv"), ["id", "no, te", "last", "absent"], "number")
        assert all(r.absent is None for r in rows.collect())
        named = found.where("number > 1").select(F.element_at(F.split("path", "/"), -1).alias("file"), "number", files.fields("record").alias("f"))
        got = [(r.file, r.number, *[(r.f[i] or None) if i < len(r.f) else None for i in range(3)]) for r in named.collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert sorted(map(str, [r[1:] for r in want])) == sorted(map(str, [(r.number, r.id, r["no, te"], r.last) for r in rows.collect()]))


def test_records_equal_those_of_a_database(spark, tmp_path):
    """The same quoted line breaks read by another engine."""
    rnd = random.Random(3)
    cells = [[f"{i}", "".join(rnd.choice(["a", "\n", '"', ",", " "]) for _ in range(rnd.randint(1, 60)))] for i in range(400)]
    with (tmp_path / "a.csv").open("w", newline="") as handle:
        csv.writer(handle, lineterminator="\n").writerows([["id", "note"], *cells])
    cut = spark.newSession()
    cut.conf.set("spark.sql.files.maxPartitionBytes", "500")
    cut.conf.set("spark.sql.files.openCostInBytes", "1")
    got = sorted(map(tuple, files.read_csv(cut, str(tmp_path / "a.csv"), ["id", "note"]).collect()))
    want = duckdb.execute(f"select id, note from read_csv('{tmp_path}/a.csv', header=true, all_varchar=true, quote='\"', escape='\"')").fetchall()
    assert got == sorted(want) and len(got) == 400


def test_plain_records_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note\n" + "".join(f'{i},"a, ""b"""\n' for i in range(500)))
    df = files.read_csv(spark, str(tmp_path), ["id", "note"], "row_number")
    assert df.count() == 500 and df.where("row_number = cast(id as bigint) + 2").count() == 500
    assert plan_of(df).count("Exchange hashpartitioning") == 0


def test_a_quote_that_never_closes_takes_the_rest(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,"x\n2,y\n\n3,z\n')
    got = files.read_csv(spark, str(tmp_path), ["id", "note"], "n").collect()
    assert [tuple(r) for r in got] == [(2, "1", "x\n2,y\n\n3,z")]


def test_profile_counts_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"id","two\nlines"\nA,"x\ny"\nB,z\n\n')
    got = files.profile_files(spark, str(tmp_path), ["id", "two\nlines"], "s").first()
    assert (got.row_count, got.missing_columns, got.status) == (2, [], "PASSED")


def test_profile_matches_the_file(spark, tmp_path):
    good, empty = tmp_path / "good.csv", tmp_path / "empty.csv"
    good.write_bytes(b"\xef\xbb\xbfident,name\r\n1,a\r\n2,b\r\n")
    empty.write_text("ident\n")
    got = {r.file_path.rsplit("/", 1)[-1]: r for r in files.profile_files(spark, str(tmp_path), ["ident", "name"], "airports").collect()}
    assert len({r.checksum_md5 for r in got.values()}) == 2
    assert (got["good.csv"].row_count, got["good.csv"].missing_columns, got["good.csv"].status) == (2, [], "PASSED")
    assert got["good.csv"].file_size_bytes == good.stat().st_size
    assert (got["empty.csv"].row_count, got["empty.csv"].missing_columns, got["empty.csv"].status) == (0, ["name"], "FAILED")


def test_checksum_ignores_nothing(spark, tmp_path):
    (tmp_path / "big.csv").write_text("ident,name\n" + "".join(f"{i},n\n" for i in range(100)))

    def profile():
        return files.profile_files(spark, str(tmp_path), ["ident"], "airports").first()

    first = profile()
    assert (first.row_count, first.missing_columns) == (100, [])
    assert profile().checksum_md5 == first.checksum_md5
    (tmp_path / "big.csv").write_text("ident,name\n" + "".join(f"{i},n\n" for i in range(99)) + "99,m\n")
    assert profile().checksum_md5 != first.checksum_md5


def test_checksum_sees_the_order_of_lines(spark, tmp_path):
    def profile(numbers):
        (tmp_path / "big.csv").write_text("ident,name\n" + "".join(f"{i},n\n" for i in numbers))
        return files.profile_files(spark, str(tmp_path), ["ident"], "airports").first()

    assert profile(range(10, 60)).checksum_md5 != profile(range(59, 9, -1)).checksum_md5


def test_header_of_any_length_with_quoted_commas(spark, tmp_path):
    names = [f"c{i}" for i in range(20_000)]
    (tmp_path / "wide.csv").write_text(",".join(names) + ',"a, ""b""",last\n1\n')
    got = files.profile_files(spark, str(tmp_path), ["last", 'a, "b"', "c7", "absent"], "airports").first()
    assert got.missing_columns == ["absent"]


def test_latest_file_and_projection(spark, rows, tmp_path):
    assert files.latest_file(spark, str(tmp_path)) is None
    for name in ("b_2026_03.csv", "b_2026_04.csv"):
        (tmp_path / name).write_text("x\n")
    assert files.latest_file(spark, str(tmp_path)).endswith("b_2026_04.csv")
    df = rows([("1", "x", "9")], "Year string, Extra string, DepTime string")
    out = files.project_raw(df, {"Year": "year", "DepTime": "dep_time"}, ["year", "dep_time", "tail_number"])
    assert [tuple(r) for r in out.collect()] == [("1", "9", None)]


def test_coerce_int(rows):
    df = rows([("12",), ("12.0",), ("x",), (None,), ("1e3",)], "v string")
    assert [r.v for r in files.coerce_ints(df, ["v", "absent"]).collect()] == [12, 12, None, None, 1000]


def test_landing_replaces_only_its_own_keys(spark, rows, tmp_path):
    root = str(tmp_path / "land")
    tables.land(rows([("a", "1"), ("b", "2")], "v string, dt string"), root, ["dt"])
    tables.land(rows([("c", "2")], "v string, dt string"), root, ["dt"])
    got = spark.read.option("header", True).schema("v string, dt string").csv(root)
    assert sorted(map(tuple, got.collect())) == [("a", "1"), ("c", "2")]


def test_tables_overwrite_and_append(spark, rows, tmp_path):
    one = rows([(1,)], "v int")
    tables.write_table(one, str(tmp_path), "mart", "t")
    tables.write_table(one, str(tmp_path), "mart", "t", mode="append")
    assert tables.read_table(spark, str(tmp_path), "mart", "t").count() == 2
    tables.write_table(one, str(tmp_path), "mart", "t")
    assert tables.read_table(spark, str(tmp_path), "mart", "t").count() == 1
