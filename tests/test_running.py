import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fundpanel.operators.running import column_summary, in_ranges, quantiles, ranked_rows, running_totals
from fundpanel.plans.studies import at_ranks, concentration


@pytest.fixture(scope="module")
def hot():
    """A third of the rows share one value, another part has few values."""
    rng = np.random.default_rng(5)
    n = 6000
    v = np.where(np.arange(n) % 3 == 0, 500.0, np.round(rng.gamma(1.0, 400.0, n), 1))
    v[rng.random(n) < 0.1] = 0.1
    group = np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", "c"], n))
    return pd.DataFrame({"id": rng.permutation(n), "g": group, "v": v, "m": rng.integers(0, 50, n)})


def brute(pdf, ascending):
    out = pdf.sort_values(["v", "id"], ascending=[ascending, True]).reset_index(drop=True)
    return out.assign(n_want=np.arange(1, len(out) + 1), m_want=out["m"].cumsum())


@pytest.mark.parametrize("ranges", [None, 1, 7, 300])
def test_running_totals_equal_brute_force(spark, hot, ranges):
    df = spark.createDataFrame(hot).repartition(7)
    got = running_totals(df, "v", "id", {"m": "m"}, directions=("up", "down"), ranges=ranges).toPandas()
    assert len(got) == len(hot) and (got["m_sum"] == hot["m"].sum()).all() and (got["n_sum"] == len(hot)).all()
    for side, ascending in (("up", True), ("down", False)):
        both = brute(hot, ascending).merge(got, on="id")
        assert (both["n_want"] == both[f"n_{side}"]).all()
        assert (both["m_want"] == both[f"m_{side}"]).all()


def test_a_hot_value_is_split(spark, hot):
    rows = in_ranges(spark.createDataFrame(hot), [F.asc("v"), F.asc("id")], 60)
    assert rows.where("v = 500").select("_b").distinct().count() > 15
    assert rows.groupBy("_b").count().agg(F.max("count")).first()[0] < 500


def test_a_thousand_hot_values(spark):
    df = spark.range(60_000).select(F.pmod("id", F.lit(1000)).cast("double").alias("v"), "id", F.lit(1).alias("m"))
    got = running_totals(df, "v", "id", {"m": "m"}, ranges=80)
    place = (F.col("v") * 60 + F.floor(F.col("id") / 1000) + 1).cast("long")
    assert got.where((F.col("n_up") != place) | (F.col("m_up") != place)).count() == 0
    found = quantiles(df, "v", {"p": 0.5, "q": 1.0}, ranges=80).first()
    assert (found["n"], found["p"], found["q"]) == (60_000, 499.5, 999.0)


def test_grouped_running_totals(spark, hot):
    df = spark.createDataFrame(hot).withColumn("g", F.when(F.col("g") != "c", F.col("g")))
    got = running_totals(df, "v", "id", {"m": "m"}, groups=["g"], ranges=50).toPandas()
    for name, part in hot.assign(g=hot["g"].where(hot["g"] != "c", None)).groupby("g", dropna=False):
        mine = got[got["g"].isna()] if pd.isna(name) else got[got["g"] == name]
        both = brute(part, True).merge(mine, on="id")
        assert len(both) == len(part) and (both["n_want"] == both["n_up"]).all() and (both["m_want"] == both["m_up"]).all()


@pytest.mark.parametrize("ranges", [1, 90])
def test_null_keys_come_last_and_are_split(spark, hot, ranges):
    pdf = hot.assign(v=hot["v"].where(hot["v"] != 500.0, np.nan))
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None).cast("double")))
    got = running_totals(df, "v", "id", {"m": "m"}, directions=("up", "down"), ranges=ranges).toPandas()
    for side, ascending in (("up", True), ("down", False)):
        both = brute(pdf, ascending).merge(got, on="id")
        assert (both["n_want"] == both[f"n_{side}"]).all() and (both["m_want"] == both[f"m_{side}"]).all()


@pytest.mark.parametrize("ranges", [1, 40])
def test_sums_are_null_from_the_first_null_on(spark, ranges):
    df = spark.range(200).select("id", F.col("id").cast("double").alias("v"), F.when(F.col("id") != 120, 1.0).alias("m"), F.lit(2.0).alias("k"))
    got = {r["id"]: r for r in running_totals(df, "v", "id", {"m": "m", "k": "k"}, directions=("up", "down"), ranges=ranges).collect()}
    assert [got[i]["m_up"] for i in (0, 119, 120, 199)] == [1.0, 120.0, None, None]
    assert [got[i]["m_down"] for i in (199, 121, 120, 0)] == [1.0, 79.0, None, None]
    assert got[5]["m_sum"] is None and got[5]["k_sum"] == 400.0 and got[199]["k_up"] == 400.0


@pytest.mark.parametrize("ranges", [None, 1, 50])
def test_rows_at_ranks_are_those_of_the_curve(spark, hot, ranges):
    df = spark.createDataFrame(hot)
    whole = running_totals(df, "v", "id", {"m": "m"}, directions=("down",), ranges=ranges).where(F.col("n_down").isin(1, 100, 2500, 6000, 7000))
    few = ranked_rows(df, "v", "id", {"m": "m"}, [1, 100, 2500, 6000, 7000], ranges=ranges)
    columns = ["id", "n_down", "m_down", "n_sum", "m_sum"]
    assert sorted(whole.select(columns).collect()) == sorted(few.select(columns).collect()) and few.count() == 4


@pytest.mark.parametrize("ranges", [None, 1, 60])
def test_quantiles_equal_numpy(spark, hot, ranges):
    probs = {"p0": 0.0, "p05": 0.05, "third": 1 / 3, "p5": 0.5, "p95": 0.95, "p1": 1.0}
    df = spark.createDataFrame(hot)
    got = quantiles(df, "v", probs, ["g"], ranges).toPandas().set_index("g")
    for name, part in hot.groupby("g"):
        assert got.loc[name, "n"] == len(part)
        assert np.allclose(got.loc[name, list(probs)].astype(float), np.quantile(part["v"], list(probs.values())))
    whole = quantiles(df, "v", probs, ranges=ranges).toPandas()
    assert np.allclose(whole[list(probs)].iloc[0].astype(float), np.quantile(hot["v"], list(probs.values())))


def test_quantiles_skip_nulls_and_small_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 2.0), ("b", 7.0), ("c", None)], "g string, v double")
    got = {r["g"]: (r["n"], r["q"]) for r in quantiles(df, "v", {"q": 0.25}, ["g"]).collect()}
    assert got == {"a": (2, 1.25), "b": (1, 7.0)}


def test_column_summary(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 5.0), (6.0, None)], "a double, b double")
    got = {r["variable"]: r for r in column_summary(df, ["a", "b"]).collect()}
    assert (got["a"]["min"], got["a"]["mean"], got["a"]["median"], got["a"]["max"], got["a"]["nulls"]) == (1.0, 3.0, 2.0, 6.0, 0)
    assert (got["b"]["nulls"], got["b"]["q3"]) == (2, 5.0)


def test_curve_ends_at_hundred_and_ignores_row_order(spark, hot):
    df = spark.createDataFrame(hot)
    curve = concentration(df.withColumn("x", F.col("m")), "v", "id", {"m": "x"}, ranges=40)
    last = curve.where(F.col("n_up") == len(hot)).first()
    assert last["n_uppct"] == 100 and last["m_uppct"] == 100
    again = concentration(df.orderBy(F.rand(3)).withColumn("x", F.col("m")), "v", "id", {"m": "x"}, ranges=15)
    a, b = (c.select("id", "n_up", "n_down", "m_down").toPandas().sort_values("id", ignore_index=True) for c in (curve, again))
    assert a.equals(b)
    assert at_ranks(df.withColumn("x", F.col("m")), "v", "id", {"m": "x"}, [1, 100], ranges=9).count() == 2


SHAPES = {
    "even": lambda rng, n: rng.random(n),
    "skewed": lambda rng, n: np.exp(rng.normal(0, 8, n)),
    "few": lambda rng, n: rng.integers(0, 5, n).astype(float),
    "ties": lambda rng, n: np.where(rng.random(n) < 0.4, 7.0, rng.normal(7, 1, n)),
    "sorted": lambda rng, n: np.arange(n, dtype=float),
    "ends": lambda rng, n: np.where(rng.random(n) < 0.01, np.inf, np.where(rng.random(n) < 0.01, -np.inf, rng.random(n))),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_selection_between_bounds_equals_brute_force(spark, shape):
    """Groups large enough for the sketch, and one that is not, from parts in any order."""
    rng = np.random.default_rng(len(shape))
    v = SHAPES[shape](rng, 40_000)
    pdf = pd.DataFrame({"id": np.arange(len(v)), "v": v, "g": np.where(np.arange(len(v)) % 100 == 0, "small", "large"), "m": rng.integers(0, 9, len(v))})
    df = spark.createDataFrame(pdf).repartition(6)
    probs = {"p0": 0.0, "a": 0.001, "b": 0.25, "c": 0.5, "d": 0.9, "e": 0.999, "p1": 1.0}
    got = quantiles(df, "v", probs, ["g"]).toPandas().set_index("g")
    for g, own in pdf.groupby("g"):
        ordered = np.sort(own["v"].to_numpy())
        for name, p in probs.items():
            at = (len(ordered) - 1) * p
            lo, hi = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
            assert got.loc[g, name] == (lo if lo == hi else pytest.approx(lo + (hi - lo) * (at - np.floor(at)), rel=1e-12))
    order = pdf.sort_values(["v", "id"], ascending=[False, True]).reset_index(drop=True)
    order["total"] = order["m"].cumsum()
    ranks = [1, 2, 777, 20_000, 39_999, 40_000, 50_000]
    few = {r["n_down"]: (r["id"], r["m_down"]) for r in ranked_rows(df, "v", "id", {"m": "m"}, ranks).collect()}
    assert few == {k: (order["id"][k - 1], order["total"][k - 1]) for k in ranks if k <= len(order)}


def test_few_rows_are_moved(spark):
    """What is kept for quantiles is a small part of the values, whatever their number."""
    from fundpanel.operators import running

    df = spark.range(400_000).select((F.col("id") * 7919 % 400_009).cast("double").alias("v"))
    bounds = running._sketched(df, "v", [0.1, 0.5, 0.9], [])
    kept = running._frequencies(df, "v", [0.1, 0.5, 0.9], [], bounds, 4)
    assert kept.count() < 8_000 and kept.agg(F.sum("_n")).first()[0] == 400_000


def test_ranks_among_nulls_and_values_that_are_no_numbers(spark):
    rows = [(i, None if i % 5 == 0 else float(i), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, v double, m int")
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    got = {r["n_down"]: r["id"] for r in ranked_rows(df, "v", "id", {"m": "m"}, [1, 2400, 2401, 3000]).collect()}
    assert got == {k: order[k - 1][0] for k in (1, 2400, 2401, 3000)}
    odd = df.withColumn("v", F.when(F.col("id") == 7, float("nan")).otherwise(F.col("v")))
    assert ranked_rows(odd, "v", "id", {"m": "m"}, [1]).first()["id"] == 7
    summary = column_summary(odd.select("v"), ["v"]).first()
    assert np.isnan(summary["mean"]) and np.isnan(summary["max"]) and summary["nulls"] == 600


def test_amounts_beyond_the_decimals(spark):
    df = spark.createDataFrame([(1, 1e21), (2, 1.0), (3, 3.0), (4, None)], "id int, v double")
    got = column_summary(df, ["v"]).first()
    assert got["mean"] == pytest.approx(1e21 / 3) and got["max"] == 1e21 and got["median"] == 3.0
    curve = {r["id"]: (r["v_down"], r["v_sum"]) for r in running_totals(df.where("id < 4"), "v", "id", {"v": "v"}, directions=("down",)).collect()}
    assert curve[1] == (1e21, 1e21 + 4) and curve[2][0] == 1e21 + 4
    many = spark.createDataFrame([(i, 9e19) for i in range(40)], "id int, v double")
    last = ranked_rows(many, "v", "id", {"v": "v"}, [40], ranges=5).first()
    assert last["v_down"] == pytest.approx(40 * 9e19)
