"""Cleaning of text, codes and types."""

from pyspark.sql import functions as F

from ..functions import (
    concat_code, display_name, drop_chars, expand_year2, fold_key, if_known, label, log_value, norm_code, ordinal,
    override_code, pad_code, part as nth_part, pct, relabel, relabel_regex, rescale, round_even, sentinel_null,
    title_case as to_title, to_number as number, year_from_name,
)
from ..operators.aggregate import exact_sum
from ..operators.grid import drop_empty, trim_all, zero_as_missing as zero_null
from ..operators.infer import columns_like, distinct_values, type_counts
from ..operators.reshape import wide_to_long
from ..sources.fixed_width import by_widths, parse_fixed, parse_ragged
from ..plans.units import UNIT35_NO_SURVEY_YEAR, UNIT35_SPLIT
from .base import MONEY, query, table


def text(c):
    return c.cast(MONEY).cast("string")


@query("SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS value FROM customer")
def sentinel_to_null(spark, sf):
    balance = F.col("c_acctbal")
    written = F.when(balance > 0, text(balance)).otherwise(F.lit("<-11111>"))
    rows = table(spark, sf, "customer").select("c_custkey", written.alias("written"))
    return rows.select("c_custkey", number(sentinel_null(F.col("written"))).alias("value"))


@query("SELECT c_custkey, c_acctbal AS value FROM customer WHERE c_acctbal > 0")
def drop_empty_facts(spark, sf):
    balance = F.col("c_acctbal")
    value = F.when(balance > 0, balance).when(balance > -500, 0.0).when(balance > -900, -11111.0)
    return drop_empty(table(spark, sf, "customer").select("c_custkey", value.alias("value")), zero=True, sentinel=-11111.0)


@query("""
SELECT l_suppkey, variable, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM (SELECT l_suppkey, nullif(l_discount, 0) AS l_discount, l_tax FROM lineitem)
UNPIVOT (value FOR variable IN (l_discount, l_tax)) GROUP BY 1, 2
""")
def zero_as_missing(spark, sf):
    long = wide_to_long(table(spark, sf, "lineitem").select("l_suppkey", "l_discount", "l_tax"), ["l_suppkey"])
    return zero_null(long, ["l_discount"]).groupBy("l_suppkey", "variable").agg(
        F.count(F.lit(1)).alias("n"), exact_sum(F.col("value")).alias("value"))


@query("""
SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN NULL WHEN 'SMALL' THEN NULL ELSE p_retailprice * 1000 END AS value FROM part
""")
def to_number(spark, sf):
    price = F.col("p_retailprice") * 1000
    written = (F.when(F.col("p_type") == "PROMO", F.lit("NaN")).when(F.col("p_type") == "SMALL", F.lit("1d"))
               .when(F.col("p_type") == "LARGE", F.concat(text(price), F.lit(" %")))
               .otherwise(F.concat(F.lit(" $"), F.format_number(price, 2))))
    return table(spark, sf, "part").select("p_partkey", number(written).alias("value"))


@query("""
SELECT o_orderkey,
  CASE WHEN regexp_matches(o_orderpriority, 'URGENT|HIGH') THEN 'Fast' WHEN regexp_matches(o_orderpriority, '^[34]') THEN 'Normal' ELSE o_orderpriority END AS speed,
  CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS status
FROM orders
""")
def relabel_rules(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", relabel_regex(F.col("o_orderpriority"), [("URGENT|HIGH", "Fast"), ("^[34]", "Normal")]).alias("speed"),
        relabel(F.col("o_orderstatus"), {"F": "Finished", "O": "Open"}).alias("status"))


@query("""
SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'Teacher''s Fund-Año' WHEN 1 THEN 'Peña Ñandú' ELSE 'Élan D''état' END AS title FROM supplier
""")
def title_case_any_letters(spark, sf):
    """Letters beyond ASCII and apostrophes inside words."""
    k = F.col("s_suppkey") % 3
    name = F.when(k == 0, "TEACHER'S FUND-AÑO").when(k == 1, "PEÑA ÑANDÚ").otherwise("ÉLAN D'ÉTAT")
    return table(spark, sf, "supplier").select("s_suppkey", to_title(name).alias("title"))


@query("""
SELECT s_suppkey, CAST(CASE s_suppkey % 4 WHEN 0 THEN s_suppkey END AS INTEGER) AS code, CAST(CASE WHEN s_suppkey % 4 < 2 THEN s_suppkey END AS INTEGER) AS cell FROM supplier
""")
def bad_codes(spark, sf):
    """Codes beyond an int and text are null, and fractions in whole-number cells."""
    k, key = F.col("s_suppkey") % 4, F.col("s_suppkey").cast("string")
    written = F.when(k == 0, key).when(k == 1, "9999999999").when(k == 2, "x").otherwise(F.lit("1e30"))
    cell = F.when(k < 2, F.concat(key, F.lit(".0"))).when(k == 2, F.concat(key, F.lit(".9"))).otherwise(F.lit("99999999999"))
    line = F.concat(F.rpad(key, 12, " "), F.lpad(cell, 14, " ")).alias("value")
    rows = parse_fixed(table(spark, sf, "supplier").select(line, norm_code(written).alias("code")), by_widths([12, 14], ["id", "cell"], ["string", "int"]))
    return rows.select(F.col("id").cast("long").alias("s_suppkey"), "code", "cell")


@query("""
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ')
  || ', Short-' || upper(p_type[1]) || lower(p_type[2:]) AS title FROM part
""")
def title_case(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", to_title(F.concat("p_name", F.lit(", SHORT-"), "p_type")).alias("title"))


@query("""
SELECT c_custkey, CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 3 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0') ELSE CAST(c_custkey AS VARCHAR) END AS code
FROM customer
""")
def pad_codes(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", pad_code(F.col("c_custkey").cast("string"), 3).alias("code"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def expand_two_digit_year(spark, sf):
    two = F.date_format("o_orderdate", "yy")
    return table(spark, sf, "orders").select("o_orderkey", expand_year2(two).alias("year"))


@query("""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS by_prefix, CAST(year(o_orderdate) AS INTEGER) AS by_item,
  CAST(year(o_orderdate) AS INTEGER) AS by_table FROM orders
""")
def year_of_file(spark, sf):
    y = F.date_format("o_orderdate", "yyyy")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        year_from_name(F.concat(y, F.lit("indiv_unit_reported_data.txt"))).alias("by_prefix"),
        year_from_name(F.concat(F.lit("PP_"), y, F.lit("_PP00SL_with_ann.csv"))).alias("by_item"),
        year_from_name(F.concat(F.lit("ret"), F.substring(y, 3, 2), F.lit("t4.xls"))).alias("by_table"))


@query("SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN p_brand ELSE p_name END AS shown FROM part")
def display_names(spark, sf):
    name = F.when(F.col("p_type") == "SMALL", F.lit("  ")).otherwise(F.concat(F.col("p_name"), F.lit("  ")))
    rows = trim_all(table(spark, sf, "part").select("p_partkey", "p_brand", name.alias("name")))
    return rows.select("p_partkey", display_name(F.col("name"), F.col("p_brand")).alias("shown"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'State' WHEN 'O' THEN 'Local' END AS adminf,
  CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS INTEGER) AS level FROM orders
""")
def label_ordinal(spark, sf):
    adminf = label(F.col("o_orderstatus"), ["F", "O"], ["State", "Local"])
    return table(spark, sf, "orders").select("o_orderkey", adminf.alias("adminf"), ordinal(adminf, ["State", "Local"]).alias("level"))


@query("""
SELECT s_suppkey, CAST(s_nationkey AS INTEGER) AS code, CASE WHEN s_nationkey = 5 THEN 'NATL' ELSE lower(s_name) END AS place,
  lower(s_name) AS folded, s_nationkey || '_' || s_name AS composite, replace(s_name, '#', '') AS plain,
  split_part(s_name, '#', 2) AS digits, CASE WHEN s_acctbal > 0 THEN round(ln(s_acctbal), 6) END AS logged,
  s_acctbal / 1000 AS thousands, CASE WHEN s_acctbal < 0 THEN 'low' ELSE 'high' END AS side,
  round_even(s_suppkey / 2, 0) AS even,
  s_acctbal / nullif(s_nationkey, 0) * 100 AS share
FROM supplier
""")
def scalar_tools(spark, sf):
    name, balance = F.col("s_name"), F.col("s_acctbal")
    key = F.col("s_nationkey").cast("string")
    return table(spark, sf, "supplier").select(
        "s_suppkey",
        norm_code(F.concat(F.lit(" "), key, F.lit(".0 "))).alias("code"),
        override_code(F.lower(name), key, {"5": "NATL"}).alias("place"),
        fold_key(F.concat(F.lit(" "), name)).alias("folded"),
        concat_code(key, name, sep="_").alias("composite"),
        drop_chars(name, "#").alias("plain"),
        nth_part(name, "#", 2).alias("digits"),
        F.round(log_value(balance), 6).alias("logged"),
        rescale(balance, 1000).alias("thousands"),
        if_known(balance < 0, F.lit("low"), F.lit("high")).alias("side"),
        round_even(F.col("s_suppkey") / 2).alias("even"),
        pct(balance, F.col("s_nationkey").cast("double")).alias("share"))


def _unit_lines(spark, sf):
    """Lines as 35-character unit records."""
    key = F.lpad((F.col("l_suppkey") % 1000).cast("string"), 3, "0")  # a county code has three places
    two = F.substring(F.year("l_shipdate").cast("string"), 3, 2)
    record = F.concat(
        F.lpad((F.col("l_linenumber") * 7).cast("string"), 2, "0"), F.col("l_linenumber").cast("string"),
        F.lit("001"), key, F.lit("000"), F.lit("01"), F.concat(F.lit("Z0"), F.col("l_linenumber").cast("string")),
        F.lpad(F.col("l_quantity").cast("int").cast("string"), 12, " "), two, two, F.lit("11"))
    return table(spark, sf, "lineitem").select(record.alias("value"))


@query("""
SELECT lpad(CAST(l_linenumber * 7 AS VARCHAR), 2, '0') AS stcode, CAST(l_linenumber AS INTEGER) AS admin, 'Z0' || l_linenumber AS ic,
  CAST(year(l_shipdate) % 100 AS INTEGER) AS dyear, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM lineitem GROUP BY 1, 2, 3, 4
""")
def fixed_width_units(spark, sf):
    rows = parse_fixed(_unit_lines(spark, sf), UNIT35_SPLIT)
    return rows.groupBy("stcode", "admin", "ic", "dyear").agg(F.count(F.lit(1)).alias("n"), exact_sum(F.col("value")).alias("value"))


@query("""
SELECT lpad(CAST(l_linenumber * 7 AS VARCHAR), 2, '0') || l_linenumber AS place, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n
FROM lineitem GROUP BY 1, 2
""")
def fixed_width_skip(spark, sf):
    """Records with the survey year skipped, and the two-digit data year expanded."""
    rows = parse_fixed(_unit_lines(spark, sf), UNIT35_NO_SURVEY_YEAR)
    return rows.groupBy(F.substring("govid", 1, 3).alias("place"), expand_year2(F.col("datayear")).alias("year")).agg(
        F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_name AS idname, CASE WHEN c_acctbal > 0 THEN c_name || ' of ' || c_mktsegment ELSE '' END AS pubname FROM customer")
def ragged_lines(spark, sf):
    """Names to the end of the line; short lines give an empty name."""
    public = F.when(F.col("c_acctbal") > 0, F.concat("c_name", F.lit(" of "), "c_mktsegment")).otherwise("")
    record = F.concat(F.rpad(F.col("c_custkey").cast("string"), 15, " "), F.rpad("c_name", 85, " "), public)
    lines = table(spark, sf, "customer").select(F.rtrim(record).alias("value"))
    cut = parse_ragged(lines, [("id", 1, 14), ("idname", 16, 100), ("pubname", 101, None)])
    return cut.select(F.col("id").cast("long").alias("c_custkey"), "idname", "pubname")


def _part_as_text(spark, sf):
    part = table(spark, sf, "part")
    return part.select(
        F.col("p_partkey").cast("string").alias("p_partkey"), "p_name", F.col("p_size").cast("string").alias("p_size"),
        F.concat(F.lit("$"), text(F.col("p_retailprice"))).alias("price"),
        F.when(F.col("p_type") == "PROMO", "T").when(F.col("p_type") == "SMALL", "F").alias("promo"),
        F.when(F.col("p_size") > 25, F.concat(F.lit("2001-01-"), F.lpad((F.col("p_size") - 24).cast("string"), 2, "0"))).alias("date"),
        F.lit(None).cast("string").alias("empty"))


@query("""
SELECT 'p_partkey' AS variable, count(*) AS known, CAST(0 AS BIGINT) AS boolean, count(*) AS double, CAST(0 AS BIGINT) AS date FROM part
UNION ALL SELECT 'p_name', count(*), 0, 0, 0 FROM part
UNION ALL SELECT 'p_size', count(*), 0, count(*), 0 FROM part
UNION ALL SELECT 'price', count(*), 0, count(*), 0 FROM part
UNION ALL SELECT 'promo', count(*), count(*), 0, 0 FROM part WHERE p_type IN ('PROMO', 'SMALL')
UNION ALL SELECT 'date', count(*), 0, 0, count(*) FROM part WHERE p_size > 25
UNION ALL SELECT 'empty', 0, 0, 0, 0
""")
def type_census(spark, sf):
    return type_counts(_part_as_text(spark, sf))


@query("""
SELECT 'o_orderpriority' AS variable, o_orderpriority AS value FROM orders GROUP BY 2
UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders GROUP BY 2
""")
def distinct_by_pattern(spark, sf):
    orders = table(spark, sf, "orders")
    return distinct_values(orders, columns_like(orders, "PRIORITY|status"))
