"""Lookups and joins.

No side is broadcast by hint unless it is an inline code table: those are local
relations of exact size, so Catalyst broadcasts them by itself. Larger lookups
meet the facts in a shuffle join that AQE may split or turn into a broadcast."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settled


def first_per_key(table: DataFrame, keys: Sequence[str], take: Sequence[str], position: str) -> DataFrame:
    """One row per key, that of the lowest position, by a partial aggregation."""
    first = F.min_by(F.struct(*take), F.col(position)).alias("_first")
    return table.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_first.{t}").alias(t) for t in take])


def one_per_key(table: DataFrame, keys: Sequence[str], take: Sequence[str]) -> DataFrame:
    """One row per key; rows of a key that differ are an error."""
    row = F.struct(*take)
    clash = F.raise_error(F.concat(F.lit(f"several rows for the key {list(keys)} "), F.to_json(F.struct(*keys))))
    only = F.when(F.min(row) != F.max(row), clash).otherwise(F.min(row)).alias("_only")
    return table.groupBy(*keys).agg(only).select(*keys, *[F.col(f"_only.{t}").alias(t) for t in take])


def keyed(table: DataFrame, *keys: str | Sequence[str]) -> DataFrame:
    """A lookup table kept once, with sets of columns that are found to tell its rows
    apart. Lookups by one of them need not reduce it again, and Catalyst knows its size.
    Rows without a key do not count: nothing is found by them."""
    kept = settled(table)
    sets = [[k] if isinstance(k, str) else list(k) for k in keys]
    checks = []
    for k in sets:
        whole = _all(F.col(c).isNotNull() for c in k)
        checks.append(F.count_if(whole) == F.count_distinct(F.when(whole, F.struct(*k))))
    for k, unique in zip(sets, kept.agg(*[c.alias(f"_{i}") for i, c in enumerate(checks)]).first(), strict=True):
        if not unique:
            raise ValueError(f"several rows for a key {k}")
    kept._told_apart_by = [frozenset(k) for k in sets]
    return kept


def lookup(df: DataFrame, table: DataFrame, on: Mapping[str, str], take: Mapping[str, str] | Sequence[str],
           position: str | None = None, null_matches: bool = False) -> DataFrame:
    """Left lookup that never adds rows; a miss gives null.

    ``on`` maps fact columns to table columns and ``take`` table columns to output
    names. With ``position`` repeated keys count once, by the first row, and the
    reduced table is kept first, so that Catalyst knows its size; without, rows of a
    repeated key must agree, else the lookup fails. A ``keyed`` table is joined as it is."""
    take = dict(take) if isinstance(take, Mapping) else {t: t for t in take}
    keys = list(dict.fromkeys(on.values()))
    rest = [t for t in take if t not in keys]
    if position is not None:
        table = settled(first_per_key(table, keys, rest, position))
    elif null_matches or frozenset(keys) not in getattr(table, "_told_apart_by", ()):
        table = one_per_key(table, keys, rest) if rest else table.select(*keys).distinct()
    right = table.select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(on.values())],
        *[F.col(t).alias(f"_take_{o}") for t, o in take.items()],
    )
    pairs = [(F.col(f), F.col(f"_key_{i}")) for i, f in enumerate(on)]
    cond = _all(a.eqNullSafe(b) if null_matches else a == b for a, b in pairs)
    out = df.join(right, cond, "left").drop(*[f"_key_{i}" for i in range(len(on))])
    same = [o for o in take.values() if o in df.columns]
    return out.drop(*same).withColumnsRenamed({f"_take_{o}": o for o in take.values()})


def _all(conds) -> Column:
    out = None
    for c in conds:
        out = c if out is None else out & c
    return out


def natural(df: DataFrame, other: DataFrame, how: str = "left", keys: Sequence[str] | None = None) -> DataFrame:
    """Equi-join on the shared column names (or the given ones)."""
    keys = list(keys or [c for c in df.columns if c in other.columns])
    if not keys:
        raise ValueError("no shared column to join on")
    return df.join(other, keys, how)


def keep_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in the list; a null key is not."""
    return df.join(known.select(*keys), list(keys), "left_semi")


def drop_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the list; a null in the list does not empty the answer."""
    return df.join(known.select(*keys), list(keys), "left_anti")


def code_coverage(used: DataFrame, codes: DataFrame, code: str, description: str) -> DataFrame:
    """Every code met in the facts or the code table, with the side it comes from.
    The facts shrink to distinct codes before the join."""
    left = used.select(code).distinct().withColumn("src", F.lit("units"))
    both = left.join(codes.select(code, description), code, "full")
    return both.withColumn("src", F.coalesce("src", F.lit("codes")))


def unmatched_codes(used: DataFrame, codes: DataFrame, code: str, description: str) -> DataFrame:
    """Codes without a description, or descriptions without a code, or codes never used."""
    both = code_coverage(used, codes, code, description)
    return both.where(F.col(code).isNull() | F.col(description).isNull() | (F.col("src") == "codes"))


def map_variables(df: DataFrame, crosswalk: DataFrame, file: str, native: str, variable: str = "variable") -> DataFrame:
    """Names of one source to the unified vocabulary; unmapped names drop."""
    mine = crosswalk.where(F.col("file") == file).select(
        F.col("fvalue").alias("_native"), F.col("uvname").alias("_unified")
    )
    joined = df.join(mine, F.col(native).cast("string") == F.col("_native"))
    return joined.drop("_native", *([native] if native != variable else []), variable).withColumnRenamed("_unified", variable)


def recipe_rows(facts: DataFrame, recipe: DataFrame, code: str = "ic", keep_unused: bool = True) -> DataFrame:
    """Facts once for every variable whose recipe names their item code.

    The recipe is an inline table, so the inner part is a broadcast of it; recipe
    lines no fact uses are added as rows without keys. For these the facts, summed
    before, are kept and read twice, so that their sources are read once."""
    if not keep_unused:
        return facts.join(recipe, code)
    facts = settled(facts)
    matched = facts.join(recipe, code)
    unused = recipe.join(facts.select(code).distinct(), code, "left_anti")
    return matched.unionByName(unused, allowMissingColumns=True)


def scalar(table: DataFrame, c: Column) -> Column:
    """One value of a one-row table, as a subquery inside an expression."""
    return table.select(c.alias("scalar")).scalar()
