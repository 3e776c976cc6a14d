"""Rules over file listings, precedence as data, change watch, sketches, types per
vintage, re-runs and provenance, on edge rows."""

import itertools
import random

import pytest
from conftest import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from fundpanel.operators.combine import precedence_findings, serve, spans_of
from fundpanel.operators.infer import infer_types, merged_masks, narrowest, type_masks, types_by_vintage, types_of
from fundpanel.operators.sketches import distinct_sketches, merged_distinct
from fundpanel.operators.watch import change_watch, survivors, year_bitmaps
from fundpanel.provenance import carry_notes, note_of, sources_of, tracking, with_note
from fundpanel.session import settled
from fundpanel.sources.manifest import known_rules, listed_files, manifest_problems, matched, read_manifest
from fundpanel.sources.rerun import current, file_fingerprints, read_published, rerun, row_fingerprints

# manifest


@pytest.fixture
def rules(spark):
    return spark.createDataFrame([
        (1993, 2002, "{yy}ret35.txt", "narrow"), (2003, 2005, "{year}ret35noimputes.txt", "wide"), (2006, None, "{year}*(final).txt", "wide"),
    ], "first int, last int, pattern string, layout string")


def test_files_meet_their_rules(spark, rules, tmp_path):
    names = ["93ret35.txt", "02ret35.txt", "03ret35.txt", "2003ret35noimputes.txt", "2004ret35noimputes.txt.bak", "2010 x(final).txt", "2005(final).txt", "readme"]
    for n in names:
        (tmp_path / n).write_text("1\n")
    (tmp_path / "empty").write_text("")
    found = matched(listed_files(spark, str(tmp_path)), rules)
    assert rows_of(found, "name", "year", "layout") == sorted([
        ("93ret35.txt", 1993, "narrow"), ("02ret35.txt", 2002, "narrow"), ("03ret35.txt", None, None), ("2003ret35noimputes.txt", 2003, "wide"),
        ("2004ret35noimputes.txt.bak", None, None), ("2010 x(final).txt", 2010, "wide"), ("2005(final).txt", None, None), ("readme", None, None)], key=repr)
    assert {r["name"] for r in manifest_problems(found).collect()} == {"03ret35.txt", "2004ret35noimputes.txt.bak", "2005(final).txt", "readme"}
    with pytest.raises(ValueError, match="03ret35.txt: no rule"):
        read_manifest(spark, str(tmp_path), rules, {})


def test_the_yearly_files_are_known(spark):
    names = {"93ret35.txt": ("unit", 1993), "2004ret35noimputes.txt": ("unit", 2004), "2013indiv_unit_reported_data.txt": ("unit", 2013),
             "ret98t3.csv": ("table", 1998), "2003Ret05.csv": ("table", 2003), "2011retest_data.csv": ("item", 2011),
             "2012ASPPSummary.csv": ("survey", 2012), "2017asppsummary.csv": ("survey", 2017), "2017ASPPSummary.csv": (None, None), "ret03t2.csv": (None, None)}
    files = spark.createDataFrame([(f"file:///{n}", n) for n in names], "file string, name string")
    got = {r["name"]: (r["layout"], r["year"]) for r in matched(files, known_rules(spark)).collect()}
    assert got == names


def test_a_file_that_two_rules_know(spark, rules, tmp_path):
    (tmp_path / "2003ret35noimputes.txt").write_text("1")
    two = rules.unionByName(spark.createDataFrame([(2000, 2009, "{year}*.txt", "other")], rules.schema))
    found = manifest_problems(matched(listed_files(spark, str(tmp_path)), two)).collect()
    assert [(r["problem"], r["layouts"]) for r in found] == [("several rules", ["other", "wide"])]


def test_each_file_is_read_by_its_layout(spark, rules, tmp_path):
    (tmp_path / "95ret35.txt").write_text("a1\nb2\n")
    (tmp_path / "2010 + more(final).txt").write_text("3,w\n")
    (tmp_path / "2004ret35noimputes.txt").write_text('1,"x\ny"\n2,z\n')
    cut = {"narrow": lambda d: d.select("year", F.substring("line", 1, 1).alias("k"), F.substring("line", 2, 9).cast("int").alias("v")),
           "wide": lambda d: d.select("year", "row_no", F.from_csv("line", "v int, k string", {"multiLine": "true"}).alias("c")).select("year", "row_no", "c.*")}
    got = read_manifest(spark, str(tmp_path), rules, cut, records=True)
    assert rows_of(got, "year", "k", "v", "row_no") == sorted([(1995, "a", 1, None), (1995, "b", 2, None), (2004, "x\ny", 1, 1), (2004, "z", 2, 2), (2010, "w", 3, 1)], key=repr)
    with pytest.raises(ValueError, match="no reader for the layouts"):
        read_manifest(spark, str(tmp_path), rules, {"wide": cut["wide"]})


# precedence


def test_spans_equal_a_walk_over_years(spark):
    rng = random.Random(4)
    for _ in range(4):
        rows = [(f"s{i}", rng.choice([None, rng.randint(1990, 2008)]), rng.choice([None, rng.randint(1992, 2012)])) for i in range(rng.randrange(4))]
        rules = spark.createDataFrame(rows, "source string, first int, last int")
        walk = [(y, sorted({s for s, a, b in rows if (a is None or y >= a) and (b is None or y <= b)})) for y in range(1991, 2011)]
        want = [(g[0][0], g[-1][0], s) for s, g in ((s, list(g)) for s, g in itertools.groupby(walk, key=lambda r: r[1]))]
        assert [tuple(r) for r in spans_of(rules, 1991, 2010).orderBy("first").collect()] == want
        found = precedence_findings(rules, 1991, 2010).orderBy("first").collect()
        assert [(r["first"], r["last"], r["finding"]) for r in found] == [(a, b, "gap" if not s else "overlap") for a, b, s in want if len(s) != 1]
        facts = spark.createDataFrame([(f"s{i}", y) for i in range(4) for y in (None, 1991, 2000, 2010)], "source string, year int")
        kept = [(s, y) for s, y in facts.collect() if y and any(s == t and (a is None or y >= a) and (b is None or y <= b) for t, a, b in rows)]
        assert rows_of(serve(facts, rules)) == sorted(kept, key=repr)


def test_repeated_spans_do_not_repeat_rows(spark):
    rules = spark.createDataFrame([("a", 2000, 2005), ("a", 2003, None)], "source string, first int, last int")
    facts = spark.createDataFrame([("a", y) for y in range(1999, 2008)], "source string, year int")
    assert serve(facts, rules).count() == 8


# change watch


def test_watch_equals_a_walk(spark):
    rng = random.Random(2)
    rows = {(rng.choice("ab"), f"s{rng.randrange(20)}", rng.randrange(2000, 2009)) for _ in range(150)}
    df = spark.createDataFrame([*rows, *list(rows)[:40], ("a", None, 2001), ("a", "s0", None)], "g string, s string, y int").repartition(5)
    maps = year_bitmaps(df, ["g"], "s", "y", 1999)
    got = {(r["g"], r["year"]): tuple(r)[2:] for r in change_watch(maps, ["g"], 1999, 2009).collect()}
    for g in "ab":
        for y in range(1999, 2010):
            years = {s: {b for a, t, b in rows if (a, t) == (g, s)} for s in {t for a, t, _ in rows if a == g}}
            now, before = {s for s, v in years.items() if y in v}, {s for s, v in years.items() if y - 1 in v}
            ever = {s for s, v in years.items() if any(b < y for b in v)}
            assert got[g, y] == (len(now), len(now - ever), len((now & ever) - before), len(now & before), len(before - now))
    two = survivors(maps, [], 1999, 2002, 2005).first()
    pairs = {(a, s) for a, s, _ in rows}
    inside = {p: {b for a, s, b in rows if (a, s) == p} for p in pairs}
    both = [p for p in pairs if {2002, 2005} <= inside[p]]
    assert two["both"] == len(both) and two["gaps"] == sum(not {2003, 2004} <= inside[p] for p in both)
    assert two["only_a"] == sum(2002 in v and 2005 not in v for v in inside.values())


def test_years_beyond_a_bitmap_are_an_error(spark):
    df = spark.createDataFrame([("s", 1900)], "s string, y int")
    with pytest.raises(Exception, match="outside 1990"):
        year_bitmaps(df, [], "s", "y", 1990).collect()


# sketches


def test_kept_sketches_merge(spark):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("y"), (F.col("id") * 7919 % 20_011).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(0, None), (9, None)], "y long, v long"))
    kept = settled(distinct_sketches(rows, ["y"], "v"))
    assert abs(merged_distinct(kept).first()[0] - 20_011) < 0.02 * 20_011
    each = {r["y"]: r["distinct"] for r in merged_distinct(kept, ["y"]).collect()}
    exact = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.countDistinct("v").alias("n")).collect()}
    assert all(abs(each[y] - n) <= 0.02 * n for y, n in exact.items()) and each[9] == 0
    doubles = rows.select((F.col("v") / 2).alias("d"))
    assert abs(merged_distinct(distinct_sketches(doubles, [], "d")).first()[0] - 20_011) < 0.02 * 20_011


# types over vintages


def test_types_are_merged_over_files(spark):
    rows = [(2001, "T", "1", "2001-05-06", None), (2001, "F", "NA", "", None), (2002, "TRUE", "2.5", "2002-01-01", ""), (2003, "1", "x", "2003-02-03", None), (2004, "F", "3", "soon", None)]
    df = spark.createDataFrame(rows, "year int, flag string, num string, day string, none string")
    masks = type_masks(df, ["year"])
    got = {(r["year"], r["variable"]): (r["own"], r["upto"], r["overall"], r["breaks"]) for r in types_by_vintage(masks, "year").collect()}
    assert got[2001, "flag"] == ("boolean", "boolean", "string", False) and got[2003, "flag"] == ("double", "string", "string", True)
    assert got[2004, "flag"] == ("boolean", "string", "string", False)
    assert got[2003, "num"] == ("string", "string", "string", True) and got[2004, "num"] == ("double", "string", "string", False)
    assert got[2004, "day"] == ("string", "string", "string", True) and got[2004, "none"] == ("boolean", "boolean", "boolean", False)
    assert types_of(masks) == infer_types(df.drop("year")) == {"flag": "string", "num": "string", "day": "string", "none": "boolean"}
    halves = type_masks(df.where("year < 2003"), ["year"]).unionByName(type_masks(df.where("year >= 2003"), ["year"]))
    assert rows_of(merged_masks(halves)) == rows_of(merged_masks(masks))
    assert merged_masks(masks).where("variable = 'num'").select("known", narrowest(F.col("types"))).first()[0] == 4


# re-runs


def test_only_changed_vintages_are_computed(spark, tmp_path):
    path, calls = str(tmp_path / "set"), []

    def run(rows, fail=False):
        df = spark.createDataFrame(rows, "year int, v string")

        def compute(years):
            calls.append(list(years))
            if fail:
                return df.withColumn("v", F.raise_error(F.lit("lost")))
            return df.withColumn("run", F.lit(len(calls)))

        return rerun(spark, path, row_fingerprints(df, "year"), compute, "year")

    with pytest.raises(ValueError, match="nothing is published"):
        read_published(spark, path)
    assert run([(2001, "a"), (2002, "b"), (2002, "b"), (2003, None)]) == ["2001", "2002", "2003"]
    assert run([(2002, "b"), (2003, None), (2001, "a"), (2002, "b")]) == [] and len(calls) == 1
    with pytest.raises(Exception, match="lost"):
        run([(2001, "a"), (2002, "b"), (2003, "c")], fail=True)
    old = [(2001, "a", 1), (2002, "b", 1), (2002, "b", 1), (2003, None, 1)]
    assert rows_of(read_published(spark, path), "year", "v", "run") == old  # the lost run left it whole
    assert run([(2001, "a"), (2002, "b"), (2004, "d")]) == ["2002", "2004"]
    assert rows_of(read_published(spark, path), "year", "v", "run") == [(2001, "a", 1), (2002, "b", 3), (2004, "d", 3)]
    assert [r["vintage"] for r in current(spark, path).orderBy("vintage").collect()] == ["2001", "2002", "2004"]


def test_a_half_written_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "set")
    df = spark.createDataFrame([(1, "a")], "year int, v string")
    rerun(spark, path, row_fingerprints(df, "year"), lambda years: df, "year")
    (tmp_path / "set" / "versions" / "2").mkdir()
    (tmp_path / "set" / "versions" / "2" / "part-0.parquet").write_bytes(b"cut off")
    assert rows_of(read_published(spark, path), "year", "v") == [(1, "a")]


def test_file_fingerprints_follow_the_files(spark, rules, tmp_path):
    (tmp_path / "95ret35.txt").write_text("a1\n")
    (tmp_path / "96ret35.txt").write_text("a1\n")

    def marks():
        return {r["vintage"]: r["fingerprint"] for r in file_fingerprints(matched(listed_files(spark, str(tmp_path)), rules)).collect()}

    before = marks()
    (tmp_path / "96ret35.txt").write_text("a1\nb2\n")
    after = marks()
    assert set(before) == {"1995", "1996"} and before["1995"] == after["1995"] and before["1996"] != after["1996"]


# provenance


def test_notes_follow_the_plan(spark):
    a = with_note(spark.createDataFrame([(1, 2.0, "x")], "k int, v double, s string"), "first")
    b = with_note(spark.createDataFrame([(1, 3.0)], "k int, w double"), "second")
    both = a.join(b, "k").withColumn("sum", F.col("v") + F.col("w")).withColumn("one", F.lit(1))
    assert sources_of(both) == {"k": ["first"], "v": ["first"], "s": ["first"], "w": ["second"], "sum": ["first", "second"], "one": []}
    stacked = a.select("k", "v").unionByName(b.select("k", F.col("w").alias("v")))
    assert sources_of(stacked) == {"k": ["first", "second"], "v": ["first", "second"]}
    sums = both.groupBy("s").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"))
    assert sources_of(sums) == {"s": ["first"], "w": ["second"], "n": []}
    known = a.join(b, "k", "left_semi").join(b.select("k"), "k", "left_anti")
    assert sources_of(known) == {"k": ["first"], "v": ["first"], "s": ["first"]}
    long = both.select("k", "v", "w").unpivot("k", ["v", "w"], "name", "value")
    assert sources_of(long)["value"] == ["first", "second"] and sources_of(long)["k"] == ["first"]
    spread = a.select("k", F.explode(F.split("s", "")).alias("c"))
    assert sources_of(spread) == {"k": ["first"], "c": ["first"]}
    ranked = both.withColumn("r", F.sum("w").over(Window.partitionBy("s")))
    assert "second" in sources_of(ranked)["r"]
    with tracking():
        copy = settled(both)
    assert sources_of(copy.select("sum")) == {"sum": ["first", "second"]}
    assert note_of(carry_notes(sums).select("w")) == "second"
    assert sources_of(spark.range(2).distinct().orderBy("id").limit(1)) == {"id": []}
