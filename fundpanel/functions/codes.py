"""Codes to labels and back, as literal expressions without a join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def label(c: Column, levels: Sequence, labels: Sequence[str]) -> Column:
    """Label of a code; an unknown or null code gives null."""
    return _first_match((c == F.lit(lv), F.lit(lb)) for lv, lb in zip(levels, labels, strict=True))


def ordinal(c: Column, levels: Sequence) -> Column:
    """Place (from 1) of a value in a closed list, null when it is not there."""
    return F.nullif(F.array_position(F.lit(list(levels)), c), F.lit(0).cast("long")).cast("int")


def relabel(c: Column, names: Mapping[str, str]) -> Column:
    """Replace whole values; others stay."""
    return _first_match(((c == F.lit(k), F.lit(v)) for k, v in names.items()), c)


def relabel_regex(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Replace by the label of the first pattern found; others stay."""
    return _first_match(((c.rlike(p), F.lit(v)) for p, v in rules), c)


def override_code(c: Column, key: Column, special: Mapping[str, str], unknown: str | None = None) -> Column:
    """Looked-up value with special keys set by hand, and an optional value for misses."""
    fallback = c if unknown is None else F.coalesce(c, F.lit(unknown))
    return _first_match(((key == F.lit(k), F.lit(v)) for k, v in special.items()), fallback)


def _first_match(branches, otherwise: Column | None = None) -> Column:
    out = None
    for cond, value in branches:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    if out is None:
        raise ValueError("an empty list of codes")
    return out if otherwise is None else out.otherwise(otherwise)
