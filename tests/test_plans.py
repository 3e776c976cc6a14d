"""Panel plans on small fixtures in the layout of the yearly files."""

import pytest
from pyspark.sql import functions as F

from fundpanel.operators.quality import duplicate_keys
from fundpanel.plans import historical, items, panels, plan_table, state_panel, studies, survey, tables, units
from fundpanel.sources import code_table, read_grid, tag_vintage
from fundpanel.sources.sinks import note_of

from conftest import rows_of

IDS = ["SortCode", "ID", "State", "FIPS"]


def sheet(header, rows):
    return [["junk"]] * 11 + [header] + rows


@pytest.fixture
def history(grid):
    finance = grid({"fin": sheet([*IDS, "Pasis", "SAS VAR NAME>", "Type", "Year", "TotERCashSec", "Benefits"], [
        ["1", " 01000", "", "", "", "AL State Total", "1", "1957", "1,000", "-11111"],
        ["1", "01000", "", "", "", "State-Admin", "2.0", "1957", "600", "0"],
        ["1", "52000", "", "", "", "US Total", "1", "1957", "9", "9"],
        ["1", "01000", "", "", "", "Other", "x", "1957", "7", "7"],
        ["1", "01000", "", "", "", "Fed", "4", "1957", "7", "7"],
        ["1", "01000", "", "", "", "AL State Total", "1", "", "7", "7"],
        ["1", "01000", "", "", "", "AL State Total", "1", "1997", "77", "7"],
    ])})
    members = grid({"mem": sheet([*IDS, "SAS VAR NAME>", "Type", "Year", "Systems"], [
        ["1", "01000", "", "", "AL State Total", "1", "1957", "4"], ["1", "01000", "", "", "State-Admin", "2", "1957", "3"]])})
    return finance, members


def test_historical_panel(history, states):
    got = rows_of(historical.historical_panel(*history, states), "year", "stabbr", "admin", "adminf", "variable", "value", "source")
    assert (1957, "AL", 1, "State-local total", "totercashsec", 1000.0, "finance") in got
    assert (1957, "AL", 1, "State-local total", "benefits", None, "finance") in got
    assert (1957, "AL", 2, "State", "benefits", 0.0, "finance") in got
    assert (1957, "NATL", 1, "State-local total", "benefits", 9.0, "finance") in got
    assert (1957, "AL", 2, "State", "systems", 3.0, "membership") in got
    assert len(got) == 4 * 2 + 2


def test_historical_wide_drops_zeros_and_joins_both(history, states):
    got = rows_of(historical.historical_wide(*history, states, ["totercashsec", "benefits"], ["systems"]))
    assert got == [("AL", 1957, "State", 600.0, 0.0, 3.0), ("AL", 1957, "Total", 1000.0, 0.0, 4.0)]


def test_level_tables(grid, states):
    g = grid({"ret99t4": [["Table 4"], ["United States", "10"], ["  State", "6"], ["  Local", "4"], ["Alabama", "1,234"],
                          [" State", "(X)"], [" Local", ""], ["Not a state", "5"], ["Footnote"]]}, {"ret99t4": 1999})
    got = rows_of(tables.level_table(g, ["assets"], states), "stabbr", "admin", "year", "variable", "value")
    assert got == sorted([("US", "Total", 1999, "assets", 10.0), ("US", "State", 1999, "assets", 6.0), ("US", "Local", 1999, "assets", 4.0),
                          ("AL", "Total", 1999, "assets", 1234.0), ("AL", "State", 1999, "assets", None), ("AL", "Local", 1999, "assets", None)], key=repr)


def test_membership_table_levels(grid, states):
    labels = ["United States", "State-administered", "Local-administered", "Counties", "Municipalities", "Townships",
              "Special districts", "School districts", "Alabama"]
    g = grid({"t5": [["Alabama", "999"], *[[v, str(i)] for i, v in enumerate(labels)]]}, {"t5": 1999})
    got = rows_of(tables.membership_table(g, ["nsystems"], states), "stabbr", "admin", "value")
    assert got == sorted([("US", "Total", 0.0), ("US", "State", 1.0), ("US", "Local", 2.0), ("US", "County", 3.0), ("US", "Municipality", 4.0),
                          ("US", "Township", 5.0), ("US", "Special district", 6.0), ("US", "School district", 7.0), ("AL", "Total", 8.0)], key=repr)


def test_item_files(grid, states):
    g = grid({
        "2004": [["t"], ["State_ID", "Item_ID", "Level", "Item_Name", "Amount"],
                 ["1", "4", "1", "FROM STATE GOVERNMENT", "1,5"], ["51", "11", "8", "Total Cash and Deposits", "7"], ["note", "", "", "", ""]],
        "2007": [["State ID", "x", "Level", "Item ID", "Item Name", "CV", "Amount"], ["9", "", "x", "8", "BENEFITS", "3", "2"]],
    }, {"2004": 2004, "2007": 2007})
    got = rows_of(items.items_panel(g, states))
    assert got == sorted([(2004, "AL", 4, "State Government Contributions", 1, "State-local", 15.0),
                          (2004, "WY", 11, "Total Cash And Short-Term Investments", 8, "School district", 7.0),
                          (2007, "DC", 8, "Benefits", None, None, 2.0)], key=repr)


@pytest.fixture
def walk(spark):
    wide = code_table(spark, "assets, Cash, Cash, Cash\npayroll, Pay, Pay, Pay", ["vname", "year2012", "year2013", "year2014"])
    return survey.variable_crosswalk(wide)


def test_survey_layouts_and_repairs(spark, grid, walk, states):
    six = ["1", "19", "2", "29", "3", "39"]
    g = grid({
        "2012": [["", "United States", "", "", "Alabama", "", ""], ["Cash", "1", "2", "3", "4", "5", "(X)"], ["Pay", "0", "1", "0", "2", "0", "3"],
                 ["Unused", "1", "1", "1", "1", "1", "1"]],
        "2013": [["", "United States", *[""] * 5, "United States", "Alabama", *[""] * 4], ["Cash", *six, *six]],
        "2014": [["", "", *[""] * 5, "Alabama", *[""] * 5], ["Cash", *six, *six]],
    }, {"2012": 2012, "2013": 2013, "2014": 2014})
    got = rows_of(survey.survey_panel(g, walk, survey.layout_table(spark), states))
    want = [("US", 2012, 1, "assets", 1.0), ("US", 2012, 2, "assets", 2.0), ("US", 2012, 3, "assets", 3.0), ("AL", 2012, 1, "assets", 4.0),
            ("AL", 2012, 2, "assets", 5.0), ("US", 2012, 2, "payroll", 1.0), ("AL", 2012, 1, "payroll", 2.0), ("AL", 2012, 3, "payroll", 3.0)]
    want += [(st, y, a, "assets", float(a)) for y in (2013, 2014) for st in ("US", "AL") for a in (1, 2, 3)]
    assert got == sorted(want, key=repr)


def test_older_download_from_files(spark, tmp_path, states):
    (tmp_path / "COG_2012_x.csv").write_text(
        "GEO.id,GEO.id2,GEO.display-label,lvl0_C015,lvl2_C015\nId,Id2,Geography,State and Local; Total cash,\"Local; Total cash, more\"\n"
        '0,1,Alabama,"1,000",400\n0,9,Nowhere,1,1\n')
    (tmp_path / "PP_2013_x.csv").write_text(
        "GEO.id,GEO.id2,GEO.display-label,lvl0a_C015,lvl0b_C015,lvl1_C015,lvl2b_C015,lvl2a_C015\n"
        "Id,Id2,Geography,a; Total cash,cv; Total cash,s; Total cash,l; Total cash,cv; Total cash\n0,1,Alabama,10,0.5,6,4,0.7\n")
    paths = [str(tmp_path / "COG_2012_x.csv"), str(tmp_path / "PP_2013_x.csv")]
    g = read_grid(spark, paths, width=8)
    g = g.withColumn("year", F.regexp_extract("file", r"_(\d{4})_", 1).cast("int"))
    got = rows_of(survey.aff_panel(g, states))
    assert got == sorted([("AL", "Total", "C015", "Total cash", 2012, 1000.0), ("AL", "Local", "C015", "Total cash, more", 2012, 400.0),
                          ("AL", "Total", "C015", "Total cash", 2013, 10.0), ("AL", "State", "C015", "Total cash", 2013, 6.0),
                          ("AL", "Local", "C015", "Total cash", 2013, 4.0)], key=repr)


def test_unified_panel_of_four_eras(spark, history, grid, walk, states):
    t = tables.tables_panel({4: grid({"t": [["Alabama", "50"], ["State", "30"], ["Local", "20"]]}, {"t": 1999})}, states)
    it = items.items_panel(grid({"i": [["StateID", "ItemID", "Level", "ItemName", "Amount"], ["1", "11", "1", "x", "60"], ["1", "99", "1", "x", "1"],
                                       ["1", "11", "4", "x", "1"]]}, {"i": 2004}), states)
    sv = survey.survey_panel(grid({"s": [["", "Alabama", "", ""], ["Cash", "70", "40", "30"]]}, {"s": 2012}), walk, survey.layout_table(spark), states)
    panel = panels.census_panel(historical.historical_panel(*history, states), t, it, sv, panels.crosswalk(spark))
    got = [tuple(r) for r in panel.where("stabbr = 'AL' AND variable = 'assets'").collect()]
    assert got == [(1957, "AL", 1, "State-local", "assets", 1000.0), (1999, "AL", 1, "State-local", "assets", 50.0),
                   (2004, "AL", 1, "State-local", "assets", 60.0), (2012, "AL", 1, "State-local", "assets", 70.0),
                   (1957, "AL", 2, "State", "assets", 600.0), (1999, "AL", 2, "State", "assets", 30.0), (2012, "AL", 2, "State", "assets", 40.0),
                   (1999, "AL", 3, "Local", "assets", 20.0), (2012, "AL", 3, "Local", "assets", 30.0)]
    assert duplicate_keys(panel, ["year", "stabbr", "admin", "variable"]).count() == 0


def test_crosswalk_table(spark):
    walk = panels.crosswalk(spark)
    assert walk.count() == 53
    assert rows_of(walk.where("uvname = 'payroll'"), "file", "fvalue") == [("df4", "C044")]


def test_balance_and_yearly_panels(spark, states):
    table = spark.createDataFrame([(2003, "Alabama", "1.5", "2", "-0.5", "75", "3", None)],
                                  "`Date` int, Region string, `Pension assets` string, l string, u string, f string, g string, s string")
    got = rows_of(panels.balance_panel(table, states, unit="billions"))
    assert ("AL", "assets", "Pension assets", 2003, 1.5, "billions") in got and ("AL", "ufl.staterev", "s", 2003, None, "billions") in got
    one = spark.createDataFrame([("01", "Alabama", 2000.0, None)], "fips string, stname string, `2000` double, `2001` double")
    assert rows_of(panels.yearly_sheets_panel({"liabilities": one, "nc.er": one}, states)) == [
        ("AL", "liabilities", 2000, 2.0), ("AL", "nc.er", 2000, 2.0)]


def test_plan_table(spark):
    text = spark.createDataFrame([("1", "2001", "1", "0", "1", "3", "0", None), ("2", None, "9", "5", None, "2", "1", None)],
                                 "plan_id string, fy string, PlanType string, AdministeringGovt string, FundingMethCode1_GASB string, "
                                 "FundingMethCode2_GASB string, AssetValMethCode_GASB string, empty string")
    raw = plan_table.plans_raw(text, note="2021-10-18")
    assert dict(raw.dtypes)["empty"] == "string" and dict(raw.dtypes)["fy"] == "double"
    labelled = plan_table.plans_labelled(raw)
    assert rows_of(labelled, "planf", "adminf", "pctdollf", "openclosedf", "assetmethf") == [
        ("General-S&L", "State", "levpercent", "closed", "smoothed"), (None, "School", None, "fixed", "market")]
    assert note_of(raw) == "2021-10-18"
    names = spark.createDataFrame([("t", "v", "l", "u", "c", "more")],
                                  "`Table Name` string, `Variable Name` string, `Variable Label` string, `Format/Unit of measure` string, Code string, Notes string")
    assert plan_table.dictionary(names).columns == ["tabname", "vname", "vlabel", "units", "code", "Notes"]


def test_unit_files(spark, tmp_path, states):
    (tmp_path / "2007indiv_unit_reported_data.txt").write_text("01000100100001Z81         123070612\n" + "02300100100001Q01           5070612\n")
    lines = tag_vintage(spark.read.text(str(tmp_path)))
    (tmp_path / "ids").mkdir()
    yearly = spark.createDataFrame([("01000100100001 " + "Alabama fund".ljust(85) + "   ", 2007)], "value string, year int")
    later = spark.createDataFrame([("01000100100001 Alabama fund",)], "value string")
    names = units.system_names(yearly, later)
    assert rows_of(names, "year", "pubname") == [(2007, "Alabama fund"), (2012, "Alabama fund"), (2013, "Alabama fund")]
    codes = units.item_codes(spark.createDataFrame([("Z81", "Total* 'assets'"), ("Item code", "x"), (None, "y")], "ic string, icdesc string"),
                             code_table(spark, units.SUPPLEMENT, ["ic", "icdesc"]))
    assert codes.count() == 5
    got = rows_of(units.unit_rows(lines, names, codes, states), "year", "stabbr", "typef", "ic", "icf", "value", "dyear", "source", "pubname")
    assert got == [(2007, "AK", "Municipal/town", "Q01", None, 5.0, 6, "12", None), (2007, "AL", "State", "Z81", "Total assets", 123.0, 6, "12", "Alabama fund")]


def test_plans_2017(spark, states):
    def unit(pid, ic, v):
        return pid.rjust(9, "0") + ic.ljust(8) + str(v).rjust(15) + "17" + "16" + "12" + "R"

    lines = [unit("1", f"Z0{i}", i) for i in range(1, 6)] + [unit("1", "Z81", 2_000_000), unit("2", "Z81", 5), unit("3", "Z01", 1)]
    ids = ["000000001 01000100200000 Fund, one", "000000002 02100100200000 Two"]
    u = units.units_2017(spark.createDataFrame([(x,) for x in lines], "value string"))
    i = units.ids_2017(spark.createDataFrame([(x,) for x in ids], "value string"))
    assert rows_of(i, "pid", "stcode", "ptype") == [("000000001", "01", "State"), ("000000002", "02", "County")]
    got = rows_of(units.plans_with_members(u, i, states))
    assert got == [("000000001", "State", "Fund, one", "AL", "Alabama", 2.0, 3.0, 12.0, 15.0)]
    assert units.INVESTMENTS == ["X21", "X30", "Z77", "Z78", "X42", "X44", "X47", "X46"]


def test_state_panel_from_recipes(spark):
    facts = spark.createDataFrame([
        (2007, "a", "AL", 0, "A", "X1", 1.0), (2007, "a", "AL", 0, "A", "X1", 2.0), (2007, "b", "AL", 3, "B", "X1", 4.0), (2007, "b", "AL", 3, "B", "X2", None),
    ], "year int, id string, stabbr string, type int, pubname string, ic string, value double")
    recipe = code_table(spark, "eec, X1\nerc, X2\nerc, X9", ["variable", "ic"])
    systems = state_panel.recipe_rollup(facts, recipe)
    got = rows_of(systems, "id", "stabbr", "type", "variable", "value")
    assert ("a", "AL", 0, "eec", 3.0) in got and ("US Total", "US", 3, "eec", 4.0) in got and ("b", "AL", 3, "erc", 0.0) in got
    assert (None, None, None, "erc", 0.0) in got
    levels = rows_of(state_panel.levels_from_systems(systems), "stabbr", "type", "vname", "value")
    assert {("AL", 1, "eec", 7.0), ("AL", 2, "eec", 3.0), ("AL", 3, "eec", 4.0), ("US", 1, "eec", 7.0)} <= set(levels)


def test_real_values(spark):
    panel = spark.createDataFrame([("NJ", 2013, 1, "xcf", 10.0), ("NY", 2013, 1, "xcf", 30.0), ("XX", 2013, 1, "xcf", 1.0)],
                                  "stabbr string, year int, type int, variable string, value double")
    pop = spark.createDataFrame([(2013, "NJ", 5.0), (2013, "NY", 5.0)], "year int, stabbr string, pop double")
    gdp = spark.createDataFrame([(2013, 0.5), (2014, 1.0)], "year int, value double")
    out = state_panel.real_per_capita(panel, pop, gdp)
    assert rows_of(out, "stabbr", "valpc", "rvalue", "rvalpc") == [("NJ", 2.0, 20.0, 4.0), ("NY", 6.0, 60.0, 12.0), ("XX", None, 2.0, None)]
    assert [r["stabbr"] for r in state_panel.rank_by_real(out, 2013, ["xcf"], "xcf").collect()] == ["NY", "NJ", "XX"]


def test_size_study(spark):
    plans = spark.createDataFrame([(i, float(i), i / 10) for i in range(1, 201)], "pid int, participants double, assets double")
    got = studies.size_study(plans, limit=100)
    first = got["quantiles"].first()
    assert (first["n"], first["p0"], first["p50"], first["p100"]) == (200, 1.0, 100.5, 200.0)
    assert {r["size"]: r["n"] for r in got["sizes"].collect()}["(100,1e+03]"] == 100
    assert {r["which"]: r["n"] for r in got["shares"].collect()} == {"small": 100, "big": 100, "all": 200}
    assert studies.groups_and_median(plans.withColumn("g", F.col("pid") % 3), ["g"]).first()[:] == (3, 67.0)
