"""Yearly files of several layouts, precedence as data, changes between years, sketches and
types kept per vintage, partial re-runs, provenance, and amounts beyond 1e20."""

import uuid

from pyspark.sql import functions as F

from ..operators.aggregate import shares, size_distribution
from ..operators.combine import precedence_findings, serve, stack_tagged
from ..operators.infer import convert, type_masks, types_by_vintage, types_of
from ..operators.running import column_summary
from ..operators.sketches import distinct_sketches, merged_distinct
from ..operators.watch import change_watch, survivors, year_bitmaps
from ..plans.state_panel import reported_share
from ..plans.studies import at_ranks, concentration
from ..provenance import sources_of, tracking, with_note
from ..session import settled
from ..sources import read_text_table
from ..sources.fixed_width import by_positions, by_widths, parse_fixed
from ..sources.manifest import manifest_problems, matched, read_manifest
from ..sources.rerun import read_published, rerun, row_fingerprints
from .base import money, order_year, query, table
from .files import _folder, _yearly_files

FIRST, LAST = 1992, 2002  # beyond the years of the given tables

# (first, last, pattern, layout): 1997 is a leap to four digits, 2000 one to commas.
RULES = [(1990, 1996, "{yy}ret35-*.txt", "narrow"), (1997, 1999, "{year}ret35noimputes-*.txt", "wide"), (2000, None, "{year}aspp-*.csv", "commas")]


def _rules(spark, rows=RULES):
    return spark.createDataFrame(rows, "first int, last int, pattern string, layout string")


LAYOUTS = {
    "narrow": lambda lines: parse_fixed(lines.select("year", "line"), by_widths([14, 12], ["key", "price"], ["long", "int"]), "line"),
    "wide": lambda lines: parse_fixed(lines.select("year", "line"), by_positions([("price", 1, 20, "int"), ("key", 22, 41, "long")]), "line"),
    "commas": lambda lines: lines.select("year", F.from_csv("line", "key long, price int", {"quote": '"'}).alias("c")).select("year", "c.*"),
}


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey AS key, CAST(floor(o_totalprice) AS INTEGER) AS price FROM orders")
def three_layouts_read_back(spark, sf):
    """Files of three layouts in one folder; a table of rules over the listing says which
    is which."""
    key, price, year = F.col("o_orderkey").cast("string"), F.floor("o_totalprice").cast("string"), F.year("o_orderdate")
    line = (F.when(year <= 1996, F.concat(F.rpad(key, 14, " "), F.lpad(price, 12, " ")))
            .when(year <= 1999, F.concat(F.lpad(price, 20, " "), F.lit("|"), F.rpad(key, 20, " ")))
            .otherwise(F.concat(F.lit('"'), key, F.lit('",'), price)))

    def name(y: int) -> str:
        return next(p for first, last, p, _ in RULES if first <= y <= (last or 9999)).replace("*", "{i}")

    paths = _yearly_files(table(spark, sf, "orders").select(line.alias("value"), order_year()), name)
    return read_manifest(spark, paths[0].rsplit("/", 1)[0], _rules(spark), LAYOUTS)


@query("""
WITH names AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
SELECT CAST(year AS VARCHAR) || 'notes.txt' AS name, 'no rule' AS problem, '' AS layouts FROM names
UNION ALL SELECT CAST(year AS VARCHAR) || 'ret35noimputes-x.txt', 'several rules', 'narrow, wide' FROM names WHERE year BETWEEN 1997 AND 1999
UNION ALL SELECT CAST(year AS VARCHAR) || 'ret35noimputes-x.txt', 'no rule', '' FROM names WHERE NOT year BETWEEN 1997 AND 1999
""")
def manifest_findings(spark, sf):
    """Files that no rule or several rules know, as rows: one of each kind a year, by name."""
    years = table(spark, sf, "orders").select(order_year()).distinct()
    names = years.select(F.explode(F.array(*[F.concat(F.col("year").cast("string"), F.lit(n)) for n in ("notes.txt", "ret35noimputes-x.txt", "aspp-1.csv")])).alias("name"))
    files = names.select(F.concat(F.lit("file:///"), "name").alias("file"), "name", F.lit(1).cast("long").alias("size"), F.lit(None).cast("timestamp").alias("changed"))
    rules = _rules(spark, [*RULES[:2], (1990, 2010, "{year}aspp-*.csv", "commas"), (1997, 1999, "{year}ret*.txt", "narrow")])
    found = manifest_problems(matched(files, rules))
    return found.select("name", "problem", F.array_join("layouts", ", ").alias("layouts"))


# source, first, last: nothing for 1997, both for 1999, open at both ends.
PRECEDENCE = [("orders", None, 1996), ("lines", 1998, 1999), ("orders", 1999, None)]
PRECEDENCE_SQL = "(VALUES ('orders', NULL, 1996), ('lines', 1998, 1999), ('orders', 1999, NULL)) AS p(source, first, last)"


def _precedence(spark):
    return spark.createDataFrame(PRECEDENCE, "source string, first int, last int")


@query(f"""
WITH f AS (
  SELECT 'orders' AS source, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey AS key, o_totalprice AS value FROM orders
  UNION ALL SELECT 'lines', CAST(year(l_shipdate) AS INTEGER), l_orderkey, l_extendedprice FROM lineitem)
SELECT f.source, year, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM f
WHERE EXISTS (SELECT 1 FROM {PRECEDENCE_SQL} WHERE p.source = f.source AND year >= coalesce(first, 0) AND year <= coalesce(last, 9999)) GROUP BY 1, 2
""")
def served_by_table(spark, sf):
    """Two sources under a precedence table with an open end, a gap and an overlap."""
    orders = table(spark, sf, "orders").select(order_year(), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("value"))
    lines = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"), F.col("l_orderkey").alias("key"), F.col("l_extendedprice").alias("value"))
    rows = serve(stack_tagged({"orders": orders, "lines": lines}), _precedence(spark))
    return rows.groupBy("source", "year").agg(F.count(F.lit(1)).alias("n"), F.sum(money("value")).cast("double").alias("value"))


@query(f"""
WITH y AS (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1)) AS year FROM orders),
s AS (SELECT year, list_sort(list(DISTINCT source) FILTER (WHERE source IS NOT NULL)) AS sources
      FROM y LEFT JOIN {PRECEDENCE_SQL} ON year >= coalesce(first, 0) AND year <= coalesce(last, 9999) GROUP BY 1),
k AS (SELECT year, coalesce(array_to_string(sources, ', '), '') AS sources, coalesce(len(sources), 0) AS n FROM s),
r AS (SELECT *, year - row_number() OVER (PARTITION BY sources ORDER BY year) AS run FROM k)
SELECT CAST(min(year) AS INTEGER) AS first, CAST(max(year) AS INTEGER) AS last, CASE n WHEN 0 THEN 'gap' ELSE 'overlap' END AS finding, sources
FROM r WHERE n <> 1 GROUP BY sources, n, run
""")
def precedence_gaps(spark, sf):
    """Years without a source and years with two, as spans within the years of the orders."""
    span = table(spark, sf, "orders").agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b")).first()
    return precedence_findings(_precedence(spark), span["a"], span["b"])


BITMAPS_SQL = """
present AS (SELECT DISTINCT c_nationkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders JOIN customer ON c_custkey = o_custkey)
"""


def _bitmaps(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", order_year())
    maps = year_bitmaps(rows, [], "o_custkey", "year", FIRST)
    homes = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return maps.join(homes, "o_custkey")


@query(f"""
WITH {BITMAPS_SQL},
grid AS (SELECT k.c_nationkey, k.o_custkey, CAST(y AS INTEGER) AS year, p.year IS NOT NULL AS now
         FROM (SELECT DISTINCT c_nationkey, o_custkey FROM present) AS k CROSS JOIN range({FIRST}, {LAST} + 1) AS r(y) LEFT JOIN present AS p ON p.o_custkey = k.o_custkey AND p.year = y),
seen AS (SELECT *, coalesce(lag(now) OVER w, false) AS before, coalesce(bool_or(now) OVER (PARTITION BY o_custkey ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS ever
         FROM grid WINDOW w AS (PARTITION BY o_custkey ORDER BY year))
SELECT c_nationkey, year, count(*) FILTER (WHERE now) AS present, count(*) FILTER (WHERE now AND NOT ever) AS entered,
  count(*) FILTER (WHERE now AND ever AND NOT before) AS returned, count(*) FILTER (WHERE now AND before) AS stayed, count(*) FILTER (WHERE before AND NOT now) AS left
FROM seen GROUP BY 1, 2
""")
def systems_watch(spark, sf):
    """Who came, came back, stayed and left, by nation and year."""
    return change_watch(_bitmaps(spark, sf), ["c_nationkey"], FIRST, LAST)


@query(f"""
WITH {BITMAPS_SQL},
c AS (SELECT c_nationkey, o_custkey, bool_or(year = 1996) AS a, bool_or(year = 1999) AS b, count(*) FILTER (WHERE year BETWEEN 1996 AND 1999) AS n FROM present GROUP BY 1, 2)
SELECT c_nationkey, count(*) FILTER (WHERE a AND b) AS both, count(*) FILTER (WHERE a AND NOT b) AS only_a, count(*) FILTER (WHERE b AND NOT a) AS only_b,
  count(*) FILTER (WHERE a AND b AND n < 4) AS gaps FROM c GROUP BY 1
""")
def systems_of_two_years(spark, sf):
    return survivors(_bitmaps(spark, sf), ["c_nationkey"], FIRST, 1996, 1999)


@query("""
WITH y AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, o_custkey FROM orders)
SELECT year, count(DISTINCT o_custkey) AS systems, TRUE AS close FROM y GROUP BY 1
UNION ALL SELECT 'all', count(DISTINCT o_custkey), TRUE FROM y
""")
def merged_distinct_counts(spark, sf):
    """Exact distinct systems of each year and of all, and whether the estimate from kept
    and merged sketches is within 2 percent of them."""
    rows = table(spark, sf, "orders").select(order_year(), "o_custkey")
    kept = settled(distinct_sketches(rows, ["year"], "o_custkey"))
    year = F.coalesce(F.col("year").cast("string"), F.lit("all"))
    pairs = rows.distinct()
    exact = pairs.groupBy("year").agg(F.count(F.lit(1)).alias("systems")).unionByName(
        pairs.select("o_custkey").distinct().agg(F.count(F.lit(1)).alias("systems")).withColumn("year", F.lit(None).cast("int")))
    rough = merged_distinct(kept, ["year"]).unionByName(merged_distinct(kept).withColumn("year", F.lit(None).cast("int")))
    both = exact.select(year.alias("year"), "systems").join(rough.select(year.alias("year"), "distinct"), "year")
    return both.select("year", "systems", (F.abs(F.col("distinct") - F.col("systems")) <= 0.02 * F.col("systems")).alias("close"))


def _typed_files(spark, sf):
    """Yearly text files: flags are logical until 1996, then codes; days are dates until
    1998; amounts are always numbers; notes are empty but for one year."""
    year = F.year("o_orderdate")
    flag = F.when(year <= 1996, F.when(F.col("o_orderstatus") == "F", "T").otherwise("F")).otherwise(F.col("o_custkey").cast("string"))
    day = F.when(year <= 1998, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.concat(F.lit("day "), F.dayofyear("o_orderdate").cast("string")))
    note = F.when(year == 1999, F.col("o_orderpriority"))
    rows = table(spark, sf, "orders").select(order_year(), flag.alias("flag"), day.alias("day"), F.format_string("%.2f", "o_totalprice").alias("amount"), note.alias("note"))
    folder = _folder(spark, "typed")
    rows.write.partitionBy("year").csv(folder, header=True)
    return settled(read_text_table(spark, folder, file="file").withColumn("year", F.regexp_extract("file", "year=([0-9]+)", 1).cast("int")).drop("file"))


TYPES_SQL = """
own AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, v.variable,
    CASE v.variable WHEN 'flag' THEN CASE WHEN year <= 1996 THEN 'boolean' ELSE 'double' END WHEN 'day' THEN CASE WHEN year <= 1998 THEN 'date' ELSE 'string' END
      WHEN 'amount' THEN 'double' ELSE CASE WHEN year = 1999 THEN 'string' ELSE 'boolean' END END AS own
  FROM (SELECT *, year(o_orderdate) AS year FROM orders) CROSS JOIN (VALUES ('flag'), ('day'), ('amount'), ('note')) AS v(variable))
"""


@query(f"""
WITH {TYPES_SQL}
SELECT year, variable, own,
  CASE variable WHEN 'flag' THEN CASE WHEN year <= 1996 THEN 'boolean' ELSE 'string' END WHEN 'day' THEN own WHEN 'amount' THEN 'double' ELSE CASE WHEN year >= 1999 THEN 'string' ELSE 'boolean' END END AS upto,
  CASE variable WHEN 'amount' THEN 'double' ELSE 'string' END AS overall,
  (variable = 'flag' AND year = 1997) OR (variable IN ('day', 'note') AND year = 1999) AS breaks
FROM own
""")
def types_of_vintages(spark, sf):
    """The type of a column in every yearly file, and the file that broke it."""
    return types_by_vintage(settled(type_masks(_typed_files(spark, sf), ["year"])), "year")


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
  count(CASE WHEN year(o_orderdate) = 1999 THEN o_orderpriority END) AS notes, 'string double string string' AS types
FROM orders GROUP BY 1
""")
def converted_vintages(spark, sf):
    """Yearly files in the types that all of them allow; files are read once."""
    rows = _typed_files(spark, sf)
    types = types_of(type_masks(rows, ["year"]))
    done = convert(rows, {**types, "year": "double"})
    kinds = " ".join(dict(done.dtypes)[c] for c in ("flag", "amount", "day", "note"))
    return done.groupBy(F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("amount")).cast("double").alias("amount"), F.count("note").alias("notes"), F.lit(kinds).alias("types"))


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN -o_totalprice ELSE o_totalprice END AS price,
  CASE WHEN year(o_orderdate) = 1997 THEN 2 ELSE 1 END AS run FROM orders
""")
def one_vintage_again(spark, sf):
    """A set is published, one year of its input changes, and only that year is computed
    again."""
    path, rows = _folder(spark, "set"), table(spark, sf, "orders").select(order_year(), "o_orderkey", F.col("o_totalprice").alias("price"))
    later = rows.withColumn("price", F.when(F.col("year") == 1997, -F.col("price")).otherwise(F.col("price")))
    for run, given in ((1, rows), (2, later), (3, later)):
        rerun(spark, path, row_fingerprints(given, "year"), lambda years: given.withColumn("run", F.lit(run)), "year")  # noqa: B023
    return read_published(spark, path)


@query("""
SELECT x.variable, x.notes, (SELECT count(*) FROM orders) AS rows
FROM (VALUES ('year', 'orders'), ('nationkey', 'customers'), ('segment', 'customers'), ('price', 'orders'), ('balance', 'customers'), ('ratio', 'customers; orders'), ('fixed', '')) AS x(variable, notes)
""")
def columns_and_sources(spark, sf):
    """What each column of a joined, stacked and summed table comes from. Notes are set on
    the two inputs alone."""
    orders = with_note(table(spark, sf, "orders"), "orders")
    customers = with_note(table(spark, sf, "customer"), "customers")
    with tracking():
        rows = settled(orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
            order_year(), F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"), "o_totalprice", "c_acctbal"))
    halves = rows.where("year <= 1996").unionByName(rows.where("year > 1996"))
    sums = halves.groupBy("year", "nationkey", "segment").agg(F.sum("o_totalprice").alias("price"), F.max("c_acctbal").alias("balance"), F.count(F.lit(1)).alias("rows"))
    panel = sums.withColumn("ratio", F.col("price") / F.col("balance")).withColumn("fixed", F.lit(1))
    found = sources_of(panel)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.lit("; ".join(found[c])).alias("notes")) for c in panel.columns if c != "rows"]))
    return panel.agg(F.sum("rows").alias("rows")).select(cells.alias("c"), "rows").select("c.variable", "c.notes", "rows")


# Whole multiples of 2**70, some 1e21, whose sums are exact as doubles.
HUGE = float(2**70)


def _huge(spark, sf):
    """Plans with amounts beyond 1e20; every tenth holds a small one."""
    plans = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("plan"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit(2.0)).otherwise((F.col("o_orderkey") % 97 + 1) * F.lit(HUGE)).alias("assets"))
    return plans


HUGE_SQL = f"""
plans AS (SELECT o_orderkey AS plan, o_orderstatus AS status, o_orderpriority AS priority, CASE WHEN o_orderkey % 10 = 0 THEN 2.0::DOUBLE ELSE CAST(o_orderkey % 97 + 1 AS DOUBLE) * {HUGE!r}::DOUBLE END AS assets FROM orders)
"""


@query(f"""
WITH {HUGE_SQL}
SELECT 'assets' AS variable, min(assets) AS min, round(sum(assets) / count(*) / 1e18) AS mean, max(assets) AS max, count(*) FILTER (WHERE assets IS NULL) AS nulls,
  quantile_cont(assets, 0.25) AS q1, quantile_cont(assets, 0.5) AS median, quantile_cont(assets, 0.75) AS q3 FROM plans
""")
def summary_of_huge(spark, sf):
    return column_summary(_huge(spark, sf), ["assets"]).withColumn("mean", F.round(F.col("mean") / 1e18))


def _percent(a: str, b: str) -> str:
    return f"round({a} / nullif({b}, 0) * 100, 6)"


@query(f"""
WITH {HUGE_SQL}
SELECT plan, n, CAST(s / {HUGE!r} AS BIGINT) AS running, {_percent('s', 't')} AS pct
FROM (SELECT plan, row_number() OVER w AS n, sum(assets) OVER w AS s, sum(assets) OVER () AS t FROM plans WINDOW w AS (ORDER BY assets DESC, plan ROWS UNBOUNDED PRECEDING))
""")
def concentration_of_huge(spark, sf):
    curve = concentration(_huge(spark, sf), "assets", "plan", {"held": "assets"}, ["down"])
    return curve.select("plan", F.col("n_down").cast("long").alias("n"), (F.col("held_down") / HUGE).cast("long").alias("running"), F.round("held_downpct", 6).alias("pct"))


@query(f"""
WITH {HUGE_SQL}
SELECT plan, n, CAST(s / {HUGE!r} AS BIGINT) AS running FROM (SELECT plan, row_number() OVER w AS n, sum(assets) OVER w AS s FROM plans WINDOW w AS (ORDER BY assets DESC, plan ROWS UNBOUNDED PRECEDING))
WHERE n IN (1, 100, 250, 1400)
""")
def ranks_of_huge(spark, sf):
    few = at_ranks(_huge(spark, sf), "assets", "plan", {"held": "assets"}, [1, 100, 250, 1400])
    return few.select("plan", F.col("n_down").cast("long").alias("n"), (F.col("held_down") / HUGE).cast("long").alias("running"))


@query(f"""
WITH {HUGE_SQL},
b AS (SELECT CAST(CASE WHEN assets <= 2 THEN 2 ELSE 13 END AS INTEGER) AS bin, count(*) AS n, CAST(sum(assets) / {HUGE!r} AS BIGINT) AS held FROM plans GROUP BY 1)
SELECT bin, n, held, CAST(sum(held) OVER (ORDER BY bin) AS BIGINT) AS held_cum FROM b
""")
def bins_of_huge(spark, sf):
    bins = size_distribution(_huge(spark, sf), "assets", {"held": "assets"})
    return bins.select("bin", "n", *[(F.col(c) / HUGE).cast("long").alias(c) for c in ("held", "held_cum")])


@query(f"""
WITH {HUGE_SQL},
s AS (SELECT priority, sum(CASE WHEN status = 'F' THEN assets ELSE 0 END) AS f, sum(CASE WHEN status = 'O' THEN assets ELSE 0 END) AS o, sum(CASE WHEN status = 'P' THEN assets ELSE 0 END) AS p FROM plans GROUP BY 1),
r AS (SELECT priority, sum(CASE WHEN status = 'F' THEN assets ELSE 0 END) AS a, sum(CASE WHEN status <> 'F' THEN assets ELSE 0 END) AS b FROM plans GROUP BY 1)
SELECT priority, CAST(f / {HUGE!r} AS BIGINT) AS f, {_percent('f', '(f + o + p)')} AS f_pct, {_percent('a', 'b')} AS reported FROM s JOIN r USING (priority)
""")
def shares_of_huge(spark, sf):
    rows = _huge(spark, sf)
    wide = shares(rows, ["priority"], "status", ["F", "O", "P"], "assets")
    own = rows.select(F.col("priority").alias("ic"), "status", F.col("assets").alias("value"))
    reported = reported_share(own.where("status = 'F'").drop("status"), own.where("status <> 'F'").drop("status"))
    both = wide.join(reported.select(F.col("ic").alias("priority"), F.round("pct", 6).alias("reported")), "priority")
    return both.select("priority", (F.col("F") / HUGE).cast("long").alias("f"), F.round("F_pct", 6).alias("f_pct"), "reported")

