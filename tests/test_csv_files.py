"""CSV files with different headers, line breaks in cells and broken rows."""

import pytest
from pyspark.sql import functions as F

from rillflow.schemas import table
from rillflow.sources import csvfiles
from rillflow.sources.positions import blocks_of, number_rows, shifts
from rillflow.sources.tables import land, load_by_name, typed_scan


@pytest.fixture
def small_blocks(spark):
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


def landed(spark, path, columns, **options):
    df, n = land(spark, str(path), columns, **options)
    got = [tuple(r) for r in df.orderBy("row_index").collect()]
    assert n == len(got)
    return got


def test_each_file_has_its_own_header(spark, tmp_path, small_blocks):
    want = []
    headers = ["a,b,c", "c,a,b", "x,c,y,b,z,a", "b,a,c,a"]
    for k, header in enumerate(headers):
        lines = []
        for i in range(400):
            cell = {"a": f"a{k}-{i}", "b": f"b{i}", "c": f'"c,{i}"', "x": "x", "y": "", "z": "z"}
            names = header.split(",")
            lines.append(",".join(cell[n] if n not in names[:j] else "again" for j, n in enumerate(names)))
            want.append((len(want), f"a{k}-{i}", f"b{i}", f"c,{i}"))
        (tmp_path / f"{k}.csv").write_text("\n".join([header, *lines]) + "\n")
    assert landed(spark, tmp_path, ["a", "b", "c"]) == want
    assert landed(spark, tmp_path, ["c"], start=7) == [(7 + i, c) for i, _, _, c in want]


def test_line_breaks_in_cells(spark, tmp_path, small_blocks):
    rows = [(str(i), f'two\nlines, "{i}"' if i % 3 == 0 else f"n{i}", "last\n\ncell" if i % 5 == 0 else "z") for i in range(300)]
    quoted = [",".join('"' + c.replace('"', '""') + '"' for c in r) for r in rows]
    (tmp_path / "b.csv").write_text("\n".join(["id,name,note", *quoted]) + "\n")
    plain = [(f"p{i}", "name", "5 inch") for i in range(500)]
    (tmp_path / "a.csv").write_text("\n".join(["note,name,id", *[",".join(r[::-1]) for r in plain]]) + "\n")
    want = [(i, *r) for i, r in enumerate(plain + rows)]
    assert landed(spark, tmp_path, ["id", "name", "note"]) == want


def test_a_cell_of_the_first_line_that_fills_all_places(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"one\ntwo"\n2,"a,b\nc,d"\n3,x\n')
    assert landed(spark, tmp_path, ["id", "name"]) == [(0, "1", "one\ntwo"), (1, "2", "a,b\nc,d"), (2, "3", "x")]


def test_file_names_with_odd_characters(spark, tmp_path):
    for n, name in enumerate(["a b.csv", "a%20b.csv", "a[1].csv", "a{x,y}.csv"]):
        (tmp_path / name).write_text(f'id,name\n{n},"one\ntwo"\n')
    got = landed(spark, tmp_path, ["id", "name"])
    assert sorted(got[n][1:] for n in range(4)) == [(str(n), "one\ntwo") for n in range(4)]


def test_odd_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id,name\n1,a\n\n2,NA\n")  # a mark, a blank line, a word for nothing
    (tmp_path / "b.csv").write_text("name,id\n")  # a header alone
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text('name,id,more\n"say ""hi""",3\nx,4,y,z,zz\n')  # short and long rows
    assert landed(spark, tmp_path, ["id", "name"]) == [
        (0, "1", "a"), (1, "2", None), (2, "3", 'say "hi"'), (3, "4", "x"),
    ]
    with pytest.raises(ValueError, match=r"Missing required columns: \['more'\]"):
        land(spark, str(tmp_path), ["id", "more"])


def test_load_by_name_keeps_broken_rows_apart(spark, tmp_path):
    (tmp_path / "one.csv").write_text('ID,Price,note\n1,1.5,x\n2,oops,x\n3\n4,2,"a, ""b""",5\n5,3,x,y,"z, z",w\n')
    (tmp_path / "two.csv").write_text("note,id\n,6\n7\n")
    schema = table("id long, name string, price double")
    good, bad = load_by_name(spark, [str(tmp_path)], schema)
    assert sorted(map(tuple, good.collect())) == [(1, None, 1.5), (6, None, None)]
    assert sorted(map(tuple, bad.collect())) == [
        ("value", '{"id":"2","name":null,"price":"oops"}'),
        ("width", "3"),
        ("width", '4,2,"a, ""b""",5'),
        ("width", '5,3,x,y,"z, z",w'),
        ("width", "7"),
    ]


def test_typed_scan_reads_each_file_by_its_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n2,1\n")
    (tmp_path / "y.csv").write_text("a,c,b\n3,z,4\n")
    (tmp_path / "x.txt").write_text("b,a\n9,9\n")
    got = typed_scan(spark, str(tmp_path), table("a long, b double"), pattern="*.csv")
    assert sorted(map(tuple, got.collect())) == [(1, 2.0), (3, 4.0)]


def test_many_blocks_are_numbered_without_moving_rows(spark):
    n = 800_000  # blocks of made-up files, two rows each
    rows = spark.range(0, 2 * n, 1, 8).select(
        F.expr(f"concat('file-', lpad(id div 2 div 1000, 6, '0'))").alias("_file"),
        (F.expr("id div 2 % 1000") * 134217728).alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        F.col("id").alias("cell"),
    )
    rows = rows.withColumn("_key", F.xxhash64("_file", "_block"))
    numbered = number_rows(rows, ["cell"])
    assert numbered.where("row_index <> cell").isEmpty() and numbered.count() == 2 * n
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("hashpartitioning") == 0 or "Scan parquet" in plan


def test_blocks_count_what_is_skipped(spark):
    rows = spark.createDataFrame(
        [("f", 0, 5, 1), ("f", 0, 6, 1), ("f", 9, 100, 2), ("g", 0, 50, 3)], "_file string, _block long, _at long, _key long"
    )
    blocks = blocks_of(rows)
    got = blocks.select("_file", "_block", shifts(blocks, F.expr("int(_block = 0)")).alias("s")).collect()
    assert {(r._file, r._block): r.s for r in got} == {("f", 0): -6, ("f", 9): 1 - 100, ("g", 0): 2 - 50 - 1}


def test_row_text(spark):
    df = spark.createDataFrame([(["a", None, 'b"c', "d,e", "f\ng"],)], "x array<string>")
    assert df.select(csvfiles.row_text(F.col("x"))).first()[0] == 'a,,"b""c","d,e","f\ng"'
