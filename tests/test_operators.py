import pytest
from pyspark.sql import functions as F

from fundpanel.operators import aggregate, combine, grid as g, infer, lookup, metrics, quality, reshape
from fundpanel.sources import code_table

from conftest import rows_of


def test_unpivot_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, None, 3.0)], "id int, a double, `b.c` double")
    assert len(rows_of(reshape.wide_to_long(df, ["id"]))) == 4
    assert (1, "b.c", None) in rows_of(reshape.wide_to_long(df, ["id"]))


def test_pivot_refuses_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0)], "id int, k string, v double")
    assert rows_of(reshape.long_to_wide(df, ["id"], "k", ["a", "b"], "v")) == [(1, 1.0, 2.0), (2, 3.0, None)]
    twice = df.unionByName(df)
    with pytest.raises(Exception, match="several rows for the cell"):
        reshape.long_to_wide(twice, ["id"], "k", ["a", "b"], "v").collect()
    assert rows_of(reshape.long_to_wide_sum(twice, ["id"], "k", ["a", "b"], "v")) == [(1, 2.0, 4.0), (2, 6.0, 0.0)]


def test_lookup_never_fans_out(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    table = spark.createDataFrame([("a", 1, "first"), ("a", 2, "second"), (None, 3, "null")], "k string, pos int, v string")
    assert rows_of(lookup.lookup(facts, table, {"k": "k"}, {"v": "v"}, position="pos"), "id", "v") == [
        (1, "first"), (2, None), (3, None)]
    assert rows_of(lookup.lookup(facts, table, {"k": "k"}, {"v": "v"}, position="pos", null_matches=True), "id", "v") == [
        (1, "first"), (2, None), (3, "null")]


def test_lookup_replaces_a_column_of_that_name(spark):
    facts = spark.createDataFrame([(1, "a", "old")], "id int, k string, v string")
    table = spark.createDataFrame([("a", "new")], "k string, v string")
    assert rows_of(lookup.lookup(facts, table, {"k": "k"}, ["v"]), "id", "k", "v") == [(1, "a", "new")]


def test_anti_join_with_nulls(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    known = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows_of(lookup.drop_known(df, known, ["k"])) == [(2,)]
    assert rows_of(lookup.keep_known(df, known, ["k"])) == [(1,)]


def test_codes_both_ways(spark):
    used = spark.createDataFrame([("a",), ("z",), ("a",)], "ic string")
    codes = spark.createDataFrame([("a", "A"), ("b", "B")], "ic string, d string")
    assert rows_of(lookup.unmatched_codes(used, codes, "ic", "d"), "ic", "src", "d") == [("b", "codes", "B"), ("z", "units", None)]


def test_recipe_keeps_unused_lines(spark):
    facts = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "ic string, value double")
    recipe = code_table(spark, "v1, x\nv2, x\nv2, y\nv3, q", ["variable", "ic"])
    out = lookup.recipe_rows(facts, recipe).groupBy("variable").agg(aggregate.sum_known(F.col("value")).alias("s"))
    assert rows_of(out) == [("v1", 1.0), ("v2", 3.0), ("v3", 0.0)]


def test_precedence_and_gaps():
    rules = [("a", None, 2002), ("b", 2004, 2006), ("c", 2007, None)]
    assert combine.uncovered_years(rules, 2000, 2010) == [2003]


def test_sums_with_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("c", None)], "k string, v double")
    got = df.groupBy("k").agg(aggregate.sum_known(F.col("v")).alias("known"), aggregate.sum_strict(F.col("v")).alias("strict"))
    assert rows_of(got) == [("a", 1.0, None), ("b", 2.0, 2.0), ("c", 0.0, None)]
    assert rows_of(aggregate.sum_columns(df)) == [(None,)]


def test_totals_rows_keep_null_groups_apart(spark):
    df = spark.createDataFrame([("x", None, 1.0), ("x", "NY", 2.0), ("y", "NY", 4.0)], "k string, st string, v double")
    got = rows_of(aggregate.add_totals(df, ["k", "st"], {"st": "US"}, ["v"]))
    assert got == sorted([("x", None, 1.0), ("x", "NY", 2.0), ("y", "NY", 4.0), ("x", "US", 3.0), ("y", "US", 4.0)], key=repr)


def test_size_distribution_sums_to_all(spark):
    df = spark.createDataFrame([(i, float(i) - 3) for i in range(200)], "id int, v double")
    rows = aggregate.size_distribution(df, "v", {"v": "v"}).orderBy(F.asc_nulls_last("bin")).collect()
    assert rows[-1]["bin"] is None and rows[-1]["n_cum"] == 200
    assert abs(sum(r["n_pct"] for r in rows) - 100) < 1e-9 and rows[-1]["n_cumpct"] == 100


def test_sums_keep_small_amounts(spark):
    plans = spark.createDataFrame([(i, 5.0, 0.000001) for i in range(1000)], "pid int, participants double, assets double")
    assert float(aggregate.size_distribution(plans, "participants", {"assets": "assets"}).first()["assets"]) == 0.001
    assert metrics.small_and_big(plans, "pid", "participants", 10).where("which = 'all'").first()["assets"] == 0.001
    assert plans.agg(aggregate.sum_strict(F.col("assets"))).first()[0] == 0.001


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (5.0, 5.1, 15.0, 15.1, -5.0, None)], "v double")
    assert rows_of(aggregate.histogram(df, "v", 10)) == [(-10.0, 1), (0.0, 1), (10.0, 2), (20.0, 1)]


def test_context_fill_over_block_edges(spark, grid):
    sheet = []
    for i in range(40):
        sheet += [[f"S{i}"], ["State"], ["Local"]]
    df = grid({"f": sheet}).withColumn("label", F.get("cells", F.lit(0)))
    for block in (1_000, 7, 10, 3):
        got = g.context_fill(df, "label", {"State": 1, "Local": 2}, block=block).orderBy("row_no").collect()
        assert [r["entity"] for r in got] == [f"S{i // 3}" for i in range(120)]
        assert [r["level"] for r in got] == ["Total", "State", "Local"] * 40


def test_header_of_each_file(grid):
    df = grid({
        "a": [["junk"], ["State ID", "Item_ID", "Level", "Amount"], ["1", "2", "3", "9"]],
        "b": [["Item ID", "x", "Level"], ["7", "", "1"]],
    })
    header = g.tidy_names(g.find_header(df, 3, "Level"), {"Amount": "value"}, clean=True)
    rows = g.promote_header(df, header, ["StateID", "ItemID", "Level", "value"])
    assert "names" not in rows.columns
    out = rows.select("file", *[g.named_cell(n).alias(n) for n in ("StateID", "ItemID", "Level", "value")])
    assert rows_of(out) == [("a", "1", "2", "3", "9"), ("b", None, "7", "1", None)]


def test_marker_slice_drops_notes(grid):
    df = grid({"f": [["note"], ["United States"], ["x"], ["United States"]], "g": [["x"]]})
    got = g.slice_from_marker(df.withColumn("label", F.get("cells", F.lit(0))), "label", "United States")
    assert rows_of(got, "file", "row_no") == [("f", 2), ("f", 3), ("f", 4)]


def test_zero_as_missing(spark):
    df = spark.createDataFrame([("payroll", 0.0), ("eec", 0.0), ("payroll", 2.0), ("eec", None)], "variable string, value double")
    assert rows_of(g.zero_as_missing(df, ["payroll"])) == [("eec", 0.0), ("payroll", 2.0)]


def test_type_inference(spark):
    df = spark.createDataFrame(
        [("1,234", "T", "2001-01-31", "a", None, "1"), ("5", "FALSE", "2002/2/3", "2", "", "x"), (None, "NA", None, "3", " ", "2")],
        "num string, flag string, day string, text string, empty string, mixed string")
    types = infer.infer_types(df)
    assert types == {"num": "double", "flag": "boolean", "day": "date", "text": "string", "empty": "boolean", "mixed": "string"}
    out = infer.convert(df, types)
    assert [str(v) for v in out.collect()[1]] == ["5.0", "False", "2002-02-03", "2", "None", "x"]
    assert dict(infer.logical_to_text(out).dtypes)["flag"] == "string"
    assert infer.types_counted(out) == {"double": 1, "boolean": 2, "date": 1, "string": 2}
    assert infer.columns_like(df, "TEX") == ["text"]


def test_member_counts_propagate_nulls(spark):
    units = spark.createDataFrame(
        [("p", f"Z0{i}", float(i)) for i in range(1, 6)] + [("q", "Z01", 1.0), ("q", "Z81", 5.0)], "pid string, ic string, value double")
    got = {r["pid"]: r for r in metrics.member_counts(units).collect()}
    assert (got["p"]["members"], got["p"]["beneficiaries"], got["p"]["participants"]) == (3.0, 12.0, 15.0)
    assert got["q"]["participants"] is None


def test_small_and_big_add_up(spark):
    df = spark.createDataFrame([(1, 10.0, 5.0), (2, 20.0, 50.0), (3, 30.0, None)], "pid int, assets double, participants double")
    got = {r["which"]: r for r in metrics.small_and_big(df, "pid", "participants", 10).collect()}
    assert got["all"]["n"] == 3 and got["small"]["n"] + got["big"]["n"] == 3
    assert got["small"]["assets_share"] + got["big"]["assets_share"] == 1.0


def test_rebased_index_without_base_year(spark):
    df = spark.createDataFrame([("a", 2004, 2.0), ("a", 2005, 4.0), ("b", 2004, 1.0)], "e string, year int, value double")
    assert rows_of(metrics.rebased_index(df, ["e"], 2005), "e", "year", "ivalue") == [("a", 2004, 50.0), ("a", 2005, 100.0), ("b", 2004, None)]


def test_cash_flow_uses_parts_when_total_missing(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0, 1.0, 0.0), (9.0, 1.0, 2.0, 1.0, 16.0), (None, None, 2.0, 1.0, 4.0)],
                               "contrib double, eec double, erc double, expend double, assets double")
    assert rows_of(metrics.cash_flow(df), "contrib", "xcf", "xcf_pct") == [(3.0, 2.0, None), (9.0, 8.0, 50.0), (None, None, None)]


# Unit and published totals of some years, with the verdict noted beside them.
RECONCILED = [(2013, 3278.489, 3287.365, "undecided"), (2012, 3024.571, 3024.603, "yes"), (2011, 3011.601, 3050.401, "no"),
              (2001, 2157.629, 2157.629, "yes"), (1993, 920.572, 909.850, "undecided")]


def test_reconcile_verdicts(spark):
    units = spark.createDataFrame([(y, u) for y, u, _, _ in RECONCILED] + [(1900, 1.0)], "year int, value double")
    published = spark.createDataFrame([(y, p) for y, _, p, _ in RECONCILED], "year int, value double")
    got = {r["year"]: r["use_units"] for r in quality.reconcile(units, published, ["year"]).collect()}
    assert got == {**{y: v for y, _, _, v in RECONCILED}, 1900: "undecided"}


def test_findings_one_scan(spark):
    df = spark.createDataFrame([(157, None, 1924.0), (1, 2001, 80.0)], "plan_id int, fy int, fr double")
    got = quality.findings(df, {"no year": F.col("fy").isNull(), "ratio": F.col("fr") > 300}, ["plan_id"])
    assert rows_of(got) == [(157, "no year"), (157, "ratio")]


def test_lookup_refuses_rows_that_differ(spark):
    facts = spark.createDataFrame([(1, "a")], "id int, k string")
    table = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "k string, v string")
    assert rows_of(lookup.lookup(facts, table, {"k": "k"}, ["v"]), "id", "v") == [(1, "x")]
    clash = table.unionByName(spark.createDataFrame([("a", "z")], "k string, v string"))
    with pytest.raises(Exception, match="several rows for the key"):
        lookup.lookup(facts, clash, {"k": "k"}, ["v"]).collect()


def test_pivots_refuse_unlisted_values(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (1, "z", 5.0)], "id int, k string, v double")
    for pivot in (reshape.long_to_wide, reshape.long_to_wide_sum):
        with pytest.raises(Exception, match="values of k beside"):
            pivot(df, ["id"], "k", ["x", "y"], "v").collect()
    with pytest.raises(Exception, match="values of k beside"):
        reshape.count_matrix(df, ["id"], "k", ["x"]).collect()
    assert reshape.values_of(df, "k") == ["x", "z"]


def test_sums_are_exact_for_any_size(spark):
    df = spark.createDataFrame([("a", 1e-7), ("a", 2e-7), ("b", 1e19), ("b", 1.0), ("c", 1e30), ("c", 1.0)], "k string, v double")
    assert rows_of(df.groupBy("k").agg(aggregate.sum_known(F.col("v")).alias("s"))) == [("a", 3e-7), ("b", 1e19), ("c", 1e30)]


def test_null_sums_in_bins_and_halves(spark):
    df = spark.createDataFrame([(1, 0.5, 1.0), (2, 1.5, None), (3, 1.7, 2.0), (4, None, 4.0)], "pid int, participants double, assets double")
    bins = {r["bin"]: r for r in aggregate.size_distribution(df, "participants", {"assets": "assets"}).collect()}
    assert (float(bins[1]["assets"]), bins[2]["assets"], float(bins[None]["assets"])) == (1.0, None, 4.0)
    assert float(bins[1]["assets_cum"]) == 1.0 and bins[2]["assets_cum"] is None and bins[None]["assets_cum"] is None
    assert bins[1]["assets_pct"] is None and bins[1]["n_pct"] == 25.0
    halves = {r["which"]: r for r in metrics.small_and_big(df, "pid", "participants", 1).collect()}
    assert (halves["small"]["assets"], halves["big"]["assets"], halves["all"]["assets"], halves["all"]["parts"]) == (1.0, None, None, None)


def test_base_of_a_null_entity(spark):
    df = spark.createDataFrame([(None, 2004, 2.0), (None, 2005, 4.0)], "e string, year int, value double")
    assert rows_of(metrics.rebased_index(df, ["e"], 2005), "year", "ivalue") == [(2004, 50.0), (2005, 100.0)]


def test_keyed_tables_are_joined_as_they_are(spark):
    from fundpanel.operators.lookup import keyed, lookup

    table = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (None, "c", 7)], "k int, s string, v int")
    known = keyed(table, "k", ["k", "s"])
    facts = spark.createDataFrame([(1,), (2,), (3,), (None,)], "f int")
    got = lookup(facts, known, {"f": "k"}, {"v": "v"})
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted([(1, 5), (2, 6), (3, None), (None, None)], key=repr)
    assert "Aggregate" not in got._jdf.queryExecution().analyzed().toString()
    with pytest.raises(ValueError, match="several rows for a key"):
        keyed(table.unionByName(table), "k")
