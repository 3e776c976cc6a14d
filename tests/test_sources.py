import os

import pytest
from pyspark.sql import functions as F

import fundpanel.session as session
from fundpanel.session import shared_root
from fundpanel.plans.units import UNIT35, UNIT35_NO_SURVEY_YEAR
from fundpanel.sources import (
    by_positions, by_widths, code_table, infer_then_convert, layout_for, numbered_lines, read_csv, read_fixed,
    read_grid, read_lines_sliced, read_text_table, read_vintages, states as state_table,
)
from fundpanel.sources.fixed_width import parse_fixed
from fundpanel.sources.sinks import note_of, publish, publish_vintages, stage, with_note
from fundpanel.sources.vintages import SURVEY_FILES, TABLE_FILES, UNIT_FILES

from conftest import rows_of


def test_lines_keep_their_number_across_splits(spark, tmp_path):
    a, b = tmp_path / "a.txt", tmp_path / "b.txt"
    a.write_text("".join(f"a line {i} {'x' * (i % 50)}\n" for i in range(1, 5001)))
    b.write_text("one\ntwo\n\nfour")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        df = numbered_lines(spark, [str(a), str(b)])
        assert spark.read.text([str(a), str(b)]).rdd.getNumPartitions() > 5
        got = df.withColumn("name", F.element_at(F.split("file", "/"), -1)).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    a_rows = sorted((r.row_no, r.line) for r in got if r.name == "a.txt")
    assert [n for n, _ in a_rows] == list(range(1, 5001))
    assert all(line.startswith(f"a line {n} ") for n, line in a_rows)
    assert sorted((r.row_no, r.line) for r in got if r.name == "b.txt") == [(1, "one"), (2, "two"), (3, ""), (4, "four")]


def test_widths_and_skips(spark, tmp_path):
    f = tmp_path / "2007indiv_unit_reported_data.txt"
    f.write_text("01000100100001Z81         1239907 1\n"[:35] + "\n" + "01000100100001X11            69701\n" + "short\n")
    rows = rows_of(read_fixed(spark, str(f), UNIT35, year=True), "id", "ic", "value", "syear", "dyear", "year")
    assert ("01000100100001", "Z81", 123.0, 99, 7, 2007) in rows
    assert ("short", None, None, None, None, 2007) in rows
    skipped = by_widths([14, 3, 12, -2, 2, 2], ["govid", "ic", "value", "datayear", "source"])
    assert skipped == UNIT35_NO_SURVEY_YEAR and skipped[3].start == 32
    with pytest.raises(ValueError):
        by_widths([1, -2], ["a", "b"])


def test_positions_with_types(spark, tmp_path):
    f = tmp_path / "ids.txt"
    f.write_text("123456789 0121230010000 Plan of, things\n")
    spec = by_positions([("pid", 1, 9), ("stcode", 11, 12), ("type", 13, 13, "int"), ("uname", 25, 110)])
    assert rows_of(read_fixed(spark, str(f), spec)) == [("123456789", "01", 2, "Plan of, things")]


def test_ragged_lines(spark, tmp_path):
    f = tmp_path / "unit_id_file.txt"
    f.write_text("01000100100001 " + "Some fund".ljust(85) + "Public name that runs on and on\n" + "02000100100001 Short\n")
    got = rows_of(read_lines_sliced(spark, str(f), [("id", 1, 14), ("idname", 16, 100), ("pubname", 101, None)]))
    assert got == [("01000100100001", "Some fund", "Public name that runs on and on"), ("02000100100001", "Short", "")]


def test_grid_keeps_quoted_commas(spark, tmp_path):
    f = tmp_path / "t.csv"
    f.write_text('note\n"Time, savings", 1 ,,x\n"say ""hi""",2\n')
    got = rows_of(read_grid(spark, str(f), width=3, skip=1), "row_no", "cells")
    assert got == [(2, ["Time, savings", "1", None, "x"]), (3, ['say "hi"', "2", None])]


def test_csv_declared_and_text(spark, tmp_path):
    f = tmp_path / "d.csv"
    f.write_text('year,name,v\n2001,"a, b",1.5\nx,c,\n')
    assert rows_of(read_csv(spark, str(f), "year int, name string, v double")) == [(2001, "a, b", 1.5), (None, "c", None)]
    assert {t for _, t in read_text_table(spark, str(f)).dtypes} == {"string"}
    assert dict(infer_then_convert(spark, str(f)).dtypes) == {"year": "string", "name": "string", "v": "double"}


def test_vintages_in_one_scan(spark, tmp_path):
    for y, text in (("2012", "a\n"), ("2013", "b\n")):
        (tmp_path / f"PP_{y}_x.txt").write_text(text)
    df = read_vintages(spark.read.text, [str(tmp_path / "PP_2012_x.txt"), str(tmp_path / "PP_2013_x.txt")])
    assert rows_of(df, "year", "value", "source_file") == [(2012, "a", "PP_2012_x.txt"), (2013, "b", "PP_2013_x.txt")]


def test_file_rules_by_year():
    assert layout_for(2001, UNIT_FILES) == "01ret35.txt"
    assert layout_for(2004, UNIT_FILES) == "2004ret35noimputes.txt"
    assert layout_for(2006, UNIT_FILES) == "2006ret35imputes.txt"
    assert layout_for(2013, UNIT_FILES) == "2013indiv_unit_reported_data.txt"
    assert layout_for(2003, TABLE_FILES) == "2003Ret0" and layout_for(1999, TABLE_FILES) == "ret99t"
    assert layout_for(2017, SURVEY_FILES) == "2017asppsummary"
    with pytest.raises(ValueError):
        layout_for(1980, UNIT_FILES)


def test_code_tables(spark):
    t = code_table(spark, "a, x\n\n  b ,  y z \n", ["k", "v"])
    assert rows_of(t) == [("a", "x"), ("b", "y z")]
    st = state_table(spark)
    assert st.count() == 52
    assert {("AL", "01"), ("DC", "09"), ("WY", "51"), ("US", "00")} <= set(rows_of(st, "stabbr", "stcen"))


def test_publish_and_vintage_overwrite(spark, tmp_path):
    path = str(tmp_path / "panel")
    df = spark.createDataFrame([(2001, "a", 1.0), (2002, "b", 2.0)], "year int, s string, value double")
    publish(df, path, note="from tests")
    assert rows_of(spark.read.parquet(path), "year", "s") == [(2001, "a"), (2002, "b")]
    assert note_of(spark.read.parquet(path).drop("year")) == "from tests"
    publish_vintages(df.where("year = 2002").withColumn("s", F.lit("new")), path)
    assert rows_of(spark.read.parquet(path), "year", "s") == [(2001, "a"), (2002, "new")]
    publish(df, path, partition=None)
    assert spark.read.parquet(path).count() == 2


def test_stage_uses_the_shared_folder(spark):
    df = spark.range(5)
    out = stage(df, "five")
    assert out.count() == 5 and shared_root(spark).removeprefix("file:") in out.inputFiles()[0]
    assert note_of(with_note(df, "n")) == "n"


def test_a_cluster_must_name_its_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "shared_root", lambda _: None)
    monkeypatch.setattr(session, "on_one_machine", lambda _: False)
    with pytest.raises(ValueError):
        session.settled(spark.range(3))
    with pytest.raises(ValueError):
        stage(spark.range(3), "x")


def test_copies_are_removed(spark):
    kept = session.settled(spark.range(7))
    folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 2)[0]
    assert kept.count() == 7 and os.path.isdir(folder)
    session.clear_settled(spark)
    assert not os.path.exists(folder)


def test_quoted_line_breaks(spark, tmp_path):
    f = tmp_path / "b.csv"
    f.write_text('a,b\n"one\ntwo",1\nthree,2\n')
    assert rows_of(read_csv(spark, str(f), "a string, b int")) == [("one\ntwo", 1), ("three", 2)]
    assert read_text_table(spark, str(f)).count() == 2
    assert read_text_table(spark, str(f), line_breaks=False).count() == 3


def test_whole_cells_only(spark):
    lines = spark.createDataFrame([("1.9",), ("2.0",), ("99999999999",), ("x",)], "value string")
    assert rows_of(parse_fixed(lines, by_widths([12], ["n"], ["int"]))) == [(2,), (None,), (None,), (None,)]
