"""Records of quoted text over any split of a file."""

import csv
import io
import random

import pytest

from fundpanel.sources import numbered_lines, numbered_records, read_csv, read_grid, read_text_table
from fundpanel.sources.delimited import infer_then_convert, to_grid


@pytest.fixture
def splits(spark):
    """Files are cut every so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}

    def cut(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield cut
    for n, v in old.items():
        spark.conf.set(n, v)


def sheet(seed, rows, breaks):
    rng = random.Random(seed)
    cells = ["a", "b c", "", 'say "x"', "comma, comma", "1.5", "é中"] + ["two\nlines", "three\n\nlines\n", 'odd "\n" quote', "\n", "long\n" * 30, "return\r\nnewline"] * breaks
    return [[f"k{i}", rng.choice(cells), rng.choice(cells)] for i in range(rows)]


def as_text(rows, end="\n", last=True):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue() if last else out.getvalue().removesuffix(end)


@pytest.mark.parametrize("size", [23, 64, 300, 1 << 20])
@pytest.mark.parametrize("breaks", [0, 1])
def test_records_are_the_same_for_any_split(spark, splits, tmp_path, size, breaks):
    files = {}
    for k, (end, last) in enumerate([("\n", True), ("\r\n", True), ("\n", False)]):
        rows = sheet(k, 40, breaks)
        (tmp_path / f"f{k}.csv").write_bytes(as_text(rows, end, last).encode())
        files[f"f{k}.csv"] = rows
    (tmp_path / "empty.csv").write_text("")
    splits(size)
    grid = read_grid(spark, str(tmp_path), width=3).collect()
    got = {name: [r["cells"] for r in sorted((r for r in grid if r["file"].endswith(name)), key=lambda r: r["row_no"])] for name in files}
    assert {r["file"].rsplit("/", 1)[1] for r in grid} == set(files)
    for name, rows in files.items():
        assert got[name] == [[c.strip(" ") or None for c in r] for r in rows]
        assert sorted(r["row_no"] for r in grid if r["file"].endswith(name)) == list(range(1, len(rows) + 1))


def test_typed_rows_equal_those_of_one_task_per_file(spark, splits, tmp_path):
    rows = [["key", "text", "other"], *sheet(5, 200, 1)]
    (tmp_path / "t.csv").write_text(as_text(rows))
    schema = "key string, text string, other double"
    want = sorted(spark.read.schema(schema).csv(str(tmp_path), header=True, multiLine=True, quote='"', escape='"').collect())
    splits(50)
    df = read_csv(spark, str(tmp_path), schema)
    assert sorted(df.collect()) == want and len(want) == 200
    assert df.rdd.getNumPartitions() > 20
    text = read_text_table(spark, str(tmp_path), file="from")
    assert text.columns == ["key", "text", "other", "from"] and text.count() == 200
    assert sorted(infer_then_convert(spark, str(tmp_path)).select("key", "text").collect()) == [r[:2] for r in want]


def test_a_file_that_ends_inside_a_cell(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('a,b\n1,"open\n2,3\n')
    with pytest.raises(ValueError, match="bad.csv ends inside a quoted cell"):
        numbered_records(spark, str(tmp_path))
    rows = read_csv(spark, str(tmp_path), "a string, b string", line_breaks=False)
    assert rows.count() == 2


def test_lines_are_numbered_without_a_copy(spark, splits, tmp_path):
    lines = [f"line {i} {'x' * (i % 17)}" for i in range(500)]
    (tmp_path / "l.txt").write_text("\n".join(lines))
    splits(40)
    df = numbered_lines(spark, str(tmp_path))
    assert [r["line"] for r in sorted(df.collect(), key=lambda r: r["row_no"])] == lines
    one = df.where(df.file.endswith("l.txt") & (df.row_no == 77)).collect()
    assert [r["line"] for r in one] == [lines[76]]


def test_a_different_split_is_an_error(spark, splits, tmp_path):
    (tmp_path / "l.txt").write_text("line\n" * 500)
    splits(40)
    df = numbered_lines(spark, str(tmp_path))
    splits(90)
    with pytest.raises(Exception, match="split otherwise"):
        df.select("row_no").collect()


def test_header_names_and_marks(spark, tmp_path):
    (tmp_path / "h.csv").write_bytes('﻿a,,A,"b ""q"" , c"\n1,2,3,4\n\n5,6,7\n'.encode())
    df = read_text_table(spark, str(tmp_path))
    assert df.columns == ["a0", "_c1", "A2", 'b "q" , c']
    assert sorted(tuple(r) for r in df.collect()) == [("1", "2", "3", "4"), ("5", "6", "7", None)]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.csv").write_text("")
    assert read_text_table(spark, str(tmp_path / "none")).columns == []


def test_cells_beyond_the_width_stay(spark):
    rows = spark.createDataFrame([("a,b,c,d",), ("a",), ('"x, y" , "z"" ""q",, ',), ("",), (",",), (None,)], "line string")
    got = [r["cells"] for r in to_grid(rows, 2).collect()]
    assert got[:5] == [["a", "b", "c", "d"], ["a", None], ["x, y", 'z" "q', None, None], [None, None], [None, None]]
