"""Where each column of a table comes from, read off the analysed plan.

A note is set on the columns of an input. What is made of an input by select, join, union,
aggregation or a window need not carry it: the plan says which inputs a column was worked
out from, and ``sources_of`` follows it back. Only values count: a column does not come
from what its rows were filtered, joined or grouped by, unless that is its value."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SEPARATOR = "; "
Notes = frozenset[str]
#: Output of a plan node: attribute ids in order, each with its notes.
Output = list[tuple[int, Notes]]
_tracking = [False]


@contextmanager
def tracking():
    """Within it, tables that are settled or published keep the sources of their columns.
    Following a plan takes some time, so it is not done otherwise."""
    _tracking.append(True)
    try:
        yield
    finally:
        _tracking.pop()


def with_note(df: DataFrame, note: str) -> DataFrame:
    """Carry a provenance note in the metadata of every column."""
    for f in df.schema.fields:
        df = df.withMetadata(f.name, {**f.metadata, "comment": note})
    return df


def note_of(df: DataFrame) -> str | None:
    """The provenance note of a table, if it has one."""
    notes = {f.metadata.get("comment") for f in df.schema.fields} - {None}
    return SEPARATOR.join(sorted(notes)) or None


def sources_of(df: DataFrame) -> dict[str, list[str]]:
    """The notes of the inputs that each column was worked out from."""
    plan = df._jdf.queryExecution().analyzed()
    output, _ = _followed(iter(json.loads(plan.toJSON())), plan)
    return {f.name: sorted(notes) for f, (_, notes) in zip(df.schema.fields, output, strict=True)}


def noted_schema(df: DataFrame) -> T.StructType:
    """The schema with every column's sources as its note."""
    own = sources_of(df)
    return T.StructType([
        T.StructField(f.name, f.dataType, f.nullable, {**f.metadata, "comment": SEPARATOR.join(own[f.name])} if own[f.name] else f.metadata)
        for f in df.schema.fields])


def kept_schema(df: DataFrame) -> T.StructType:
    """The schema for a copy: with sources while they are tracked."""
    return noted_schema(df) if _tracking[-1] else df.schema


def carry_notes(df: DataFrame) -> DataFrame:
    """The table with its columns' sources in their metadata."""
    for f in noted_schema(df).fields:
        if f.metadata != df.schema[f.name].metadata:
            df = df.withMetadata(f.name, f.metadata)
    return df


def _own(plan, place: int) -> Notes:
    """Notes in the metadata of an output column, which the plan's text leaves out."""
    comment = json.loads(plan.output().apply(place).metadata().json()).get("comment")
    return frozenset(comment.split(SEPARATOR)) if comment else frozenset()


def _joined(notes) -> Notes:
    return frozenset().union(*notes)


def _id(node: dict) -> int:
    return node["exprId"]["id"]


def _followed(nodes: Iterator[dict], plan) -> tuple[Output, str]:
    """Output of the plan node that comes next, and its kind. Nodes come parents first."""
    node = next(nodes)
    kind = node["class"].rsplit(".", 1)[1]
    inner = plan.children()
    below = [_followed(nodes, inner.apply(i))[0] for i in range(node["num-children"])]
    given = [x for output in below for x in output]
    known = dict(given)
    if kind == "Project":
        return [_named(e, known, plan, k) for k, e in enumerate(node["projectList"])], kind
    if kind == "Aggregate":
        return [_named(e, known, plan, k) for k, e in enumerate(node["aggregateExpressions"])], kind
    if kind == "Window":
        return [*given, *[_named(e, known, plan, k) for k, e in enumerate(node["windowExpressions"], len(given))]], kind
    if kind == "Union":
        return [(own[0][0], _joined(n for _, n in own)) for own in zip(*below, strict=True)], kind
    if kind == "Join" and any(k in json.dumps(node["joinType"]) for k in ("LeftSemi", "LeftAnti")):
        return below[0], kind
    if kind == "Generate":
        made = _values(node["generator"], known)
        unneeded = set(node.get("unrequiredChildIndex") or [])
        return [*[x for i, x in enumerate(given) if i not in unneeded], *[(_id(a[0]), made) for a in node["generatorOutput"]]], kind
    if kind == "Expand":
        rows = plan.projections()
        cells = [[_values(json.loads(rows.apply(i).apply(k).toJSON()), known) for i in range(rows.size())] for k in range(len(node["output"]))]
        return [(_id(a[0]), _joined(own)) for a, own in zip(node["output"], cells, strict=True)], kind
    if not below:
        out = [a[0] for a in node.get("output") or []]
        return [(_id(a), _own(plan, k)) for k, a in enumerate(out)], kind
    if len(below) == 1 and node.get("output") and isinstance(node["output"], list):
        every = _joined(known.values())  # a function over whole rows
        return [(_id(a[0]), known.get(_id(a[0]), every)) for a in node["output"]], kind
    return given, kind


def _named(expression: list[dict], known: dict[int, Notes], plan, place: int) -> tuple[int, Notes]:
    top = expression[0]
    set_here = _own(plan, place) if top.get("explicitMetadata") is not None else frozenset()
    return _id(top), set_here or _values(expression, known)


def _values(expression: list[dict], known: dict[int, Notes]) -> Notes:
    return _joined(known.get(_id(n), frozenset()) for n in expression if n["class"].endswith(".AttributeReference"))
