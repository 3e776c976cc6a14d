"""Vector code compression: product codes whose nearest entry is found by a GNAT.

A vector's components become whole numbers, floor(scale * x), and the vector is cut into
PARTS equal parts. Each part position has a codebook of ENTRIES entries, at first the
parts of the vectors with the smallest ids. In every round each part goes to its nearest
entry (squared distance, ties to the lower index), and the entries that were met become
the floored means of their parts. Sums are exact, so results do not depend on the order
of rows or the number of tasks.

The nearest entry is looked up in a geometric near-neighbour access tree over the entries
of a codebook. A node has some split points; every other entry belongs to the child of its
nearest split point, and for each pair of split point and child the node keeps the least
and the greatest distance between them. A part is measured against the split points, and a
child is left out as a whole where some split point shows that all its entries are farther
away than the best one found. Distances in the tree are whole numbers rounded to the safe
side (down for least, up for greatest), and a child goes only where the bound is strictly
beyond, so that an entry at the same distance with a lower index is always looked at.
Distances that decide are squared and whole. Searches run for a whole batch at a time:
the parts that still need a child go down into it together.

Tasks send one row of sums per entry, whatever their rows; the driver holds the codebooks
(parts x entries x components). Rows are never moved.

Defined results: vectors that are null, empty or hold null or non-finite components do not
take part. The length of all is that of the first kept vector (smallest id, then smallest
vector); rows of another length, or where parts do not divide it, are returned with null
code and error. Null ids come after all others, and rows that repeat an id are ordered by
their vector. With fewer vectors than entries there are fewer entries; an empty table gives
an empty table. Components that are too large for 64-bit sums of squares are worked out in
unbounded whole numbers; an error beyond 64 bits is null. Of the given table only the three
named columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundpanel.llm.common import staged

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Split points of a node, and entries up to which there is no further node.
SPLITS, LEAF = 8, 8
Batches = Iterator[pa.RecordBatch]


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def whole_numbers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), as 64-bit numbers where squares of differences fit, else unbounded."""
    x = np.asarray(values, np.float64)
    if not x.size or np.abs(x).max() * scale < _most(x.shape[-1]):
        return np.floor(x * scale).astype(np.int64)
    exact = [math.floor(v * scale) if abs(v) < 1e300 else int(v) * scale for v in x.ravel().tolist()]
    out = np.empty(x.size, object)
    out[:] = exact
    return out.reshape(x.shape)


def _most(length: int) -> float:
    """Components below it have sums of squared differences within 64 bits."""
    return math.sqrt(2.0**61 / max(length, 1))


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(axis=-1)


def _root(x: np.ndarray, up: bool) -> np.ndarray:
    """Whole square roots, rounded up or down."""
    if x.dtype == object:
        roots = np.empty(x.shape, object)
        roots.ravel()[:] = [math.isqrt(int(v)) for v in x.ravel()]
    else:
        roots = np.sqrt(x.astype(np.float64)).astype(np.int64)
        roots -= roots * roots > x  # the float may be off by one either way
        roots += (roots + 1) * (roots + 1) <= x
    return roots + (roots * roots < x) if up else roots


class Gnat:
    """Nearest entry of a codebook, for many parts at a time."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.measured = 0  # distances worked out, for tests and reports
        self.root = self._node(np.arange(len(entries)))

    def _node(self, own: np.ndarray) -> tuple:
        if len(own) <= LEAF:
            return own, None, None, None
        splits = [0]
        far = _squared(self.entries[own], self.entries[own[0]])
        while len(splits) < SPLITS:
            splits.append(int(far.argmax()))
            far = np.minimum(far, _squared(self.entries[own], self.entries[own[splits[-1]]]))
        points = own[np.unique(splits)]  # equal entries may all lie at a split point
        rest = np.setdiff1d(own, points)
        to = _squared(self.entries[rest][:, None], self.entries[points][None])
        nearest = to.argmin(axis=1)
        groups = [np.flatnonzero(nearest == k) for k in range(len(points))]
        groups = [g for g in groups if len(g)]
        low = [_root(to[g].min(axis=0), up=False) for g in groups]
        high = [_root(to[g].max(axis=0), up=True) for g in groups]
        return points, [self._node(rest[g]) for g in groups], low, high

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each part's nearest entry."""
        index = np.full(len(parts), -1, np.int64)
        best = np.zeros(len(parts), parts.dtype)
        if len(parts):
            self._search(self.root, np.arange(len(parts)), parts, index, best)
        return index, best

    def _search(self, node: tuple, rows: np.ndarray, parts: np.ndarray, index: np.ndarray, best: np.ndarray) -> None:
        points, children, low, high = node
        to = np.stack([_squared(parts[rows], self.entries[p]) for p in points], axis=1)
        self.measured += to.size
        for k, p in enumerate(points):
            d, i, b = to[:, k], index[rows], best[rows]
            better = (i < 0) | (d < b) | ((d == b) & (p < i))
            index[rows[better]], best[rows[better]] = p, d[better]
        if children is None:
            return
        down, up = _root(to, up=False), _root(to, up=True)
        for child, least, greatest in zip(children, low, high, strict=True):
            reach = _root(best[rows], up=True)[:, None]
            out = ((down - reach > greatest) | (up + reach < least)).any(axis=1)
            if not out.all():
                self._search(child, rows[~out], parts, index, best)


def _cut(batch: pa.RecordBatch, length: int, parts: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the given length, their whole components as (row, part, component))."""
    column = batch.column("vector")
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == length)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(rows) < len(sizes):
        values = values[np.repeat(sizes == length, sizes)]
    return rows, whole_numbers(values.reshape(len(rows), length), scale).reshape(len(rows), parts, -1)


def _assigned(cut: np.ndarray, books: list[Gnat]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for part, book in enumerate(books):
        own = cut[:, part]
        if book.entries.dtype == object:
            own = own.astype(object)
        yield book.nearest(own)


def _books(entries: np.ndarray) -> list[Gnat]:
    return [Gnat(e) for e in entries]


def first_entries(kept: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray | None:
    """(part, entry, component) of the vectors with the smallest ids, all of one length."""
    first = kept.orderBy(F.asc_nulls_last("id"), "vector").limit(1).select(F.size("vector").alias("n")).collect()
    if not first or first[0]["n"] % parts:
        return None
    same = kept.filter(F.size("vector") == first[0]["n"])
    rows = same.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()  # a codebook's rows
    whole = whole_numbers(np.array([r["vector"] for r in rows], np.float64), scale)
    return np.ascontiguousarray(whole.reshape(len(rows), parts, -1).transpose(1, 0, 2))


def _sums(kept: DataFrame, entries: np.ndarray, scale: int) -> DataFrame:
    """(part, entry, place, total, met): sums of the parts that go to each entry."""
    parts, count, width = entries.shape

    def run(batches: Batches) -> Batches:
        books = _books(entries)
        total = np.zeros((parts, count, width), object)
        met = np.zeros((parts, count), np.int64)
        for batch in batches:
            _, cut = _cut(batch, parts * width, parts, scale)
            for part, (index, _) in enumerate(_assigned(cut, books)):
                met[part] += np.bincount(index, minlength=count)
                if cut.dtype == object:
                    np.add.at(total[part], index, cut[:, part])
                    continue
                order = np.argsort(index, kind="stable")
                starts = np.flatnonzero(np.diff(index[order], prepend=-1))
                if len(starts):
                    total[part][index[order][starts]] += np.add.reduceat(cut[order, part], starts, axis=0).astype(object)
        part, entry, place = (x.ravel() for x in np.indices(total.shape))
        some = met[part, entry] > 0
        yield pa.RecordBatch.from_arrays([
            pa.array(part[some], pa.int32()), pa.array(entry[some], pa.int32()), pa.array(place[some], pa.int32()),
            pa.array([Decimal(int(v)) for v in total.ravel()[some]], pa.decimal128(38, 0)), pa.array(met[part, entry][some])],
            ["part", "entry", "place", "total", "met"])

    rows = kept.select("vector").mapInArrow(run, "part int, entry int, place int, total decimal(38,0), met long")
    return rows.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("met").alias("met"))


def fit(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray | None:
    """Codebooks (part, entry, component) of a table (id, vector) of usable vectors; None
    where there is no vector, or parts do not divide its length."""
    books = first_entries(kept, parts, entries, scale)
    if books is None:
        return None
    for _ in range(rounds):
        new = books.astype(object)
        for r in _sums(kept, books, scale).collect():  # parts x entries x components at most
            new[r["part"], r["entry"], r["place"]] = int(r["total"]) // int(r["met"])
        large = max(abs(int(v)) for v in new.ravel()) >= _most(parts * books.shape[2])
        books = new if large else new.astype(np.int64)
    return books


def digest(books: np.ndarray | None) -> str:
    """SHA-256 of all entries' components, by part, entry and place."""
    values = [] if books is None else books.ravel().tolist()
    return hashlib.sha256(",".join(str(int(v)) for v in values).encode()).hexdigest()


def encoded(kept: DataFrame, books: np.ndarray | None, scale: int = SCALE) -> DataFrame:
    """Rows (id, label, vector) with their code (two hex digits a part) and error."""
    plain = kept.select("id", "label", "vector")
    if books is None:
        return plain.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    parts, _, width = books.shape
    digits = max(2, (books.shape[1] - 1).bit_length() + 3 >> 2)
    id_type, label_type = (plain.schema[c].dataType.simpleString() for c in ("id", "label"))

    def run(batches: Batches) -> Batches:
        trees = _books(books)
        for batch in batches:
            rows, cut = _cut(batch, parts * width, parts, scale)
            code, error = [None] * batch.num_rows, [None] * batch.num_rows
            index, apart = zip(*_assigned(cut, trees), strict=True)
            total = sum(a.astype(object) for a in apart)
            for k, r in enumerate(rows):
                code[r] = "".join(f"{i[k]:0{digits}x}" for i in index)
                error[r] = int(total[k]) if total[k] < 1 << 63 else None
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())], ["id", "label", "code", "error"])

    return plain.mapInArrow(run, f"id {id_type}, label {label_type}, code string, error long")


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray | None]:
    """((id, label, code, error, label_error), codebooks). label_error: errors summed over
    rows of equal label, nulls together; null where it is beyond 64 bits."""
    kept = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector")).filter(usable(F.col("vector")))
    books = fit(kept, parts, entries, rounds, scale)
    rows = staged(encoded(kept, books, scale), "codes")
    per = rows.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    return rows.join(per, F.col("label").eqNullSafe(F.col("of")), "left").drop("of"), books


def _sql() -> str:
    """The same in DuckDB's SQL. Sums of these sizes are exact as doubles."""
    def assigned(name: str, book: str) -> str:
        return f"""
{name} AS (
  SELECT vec_id, label, p, min(CAST(ab.d AS BIGINT) * {ENTRIES} + ab.e) AS de, any_value(ab.part) AS part
  FROM (SELECT a.*, b.e, list_inner_product(a.part, a.part) + list_inner_product(b.part, b.part) - 2 * list_inner_product(a.part, b.part) AS d
        FROM pieces AS a JOIN {book} AS b USING (p)) AS ab GROUP BY vec_id, label, p)"""

    def moved(name: str, book: str, by: str) -> str:
        return f"""
{name} AS (
  SELECT b.p, b.e, coalesce(m.part, b.part) AS part
  FROM {book} AS b LEFT JOIN (
    SELECT p, e, list(mean ORDER BY i) AS part
    FROM (SELECT p, de % {ENTRIES} AS e, i, floor(sum(x) / count(*)) AS mean
          FROM (SELECT p, de, unnest(part) AS x, generate_subscripts(part, 1) AS i FROM {by}) GROUP BY ALL)
    GROUP BY p, e) AS m USING (p, e))"""

    ctes = ["""
kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v, CAST(len(embedding) // 16 AS BIGINT) AS w
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""", """
pieces AS (SELECT vec_id, label, p, v[p * w + 1:p * w + w] AS part FROM kept, range(16) AS r(p))""", f"""
book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, part
  FROM pieces WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES}))"""]
    for k in range(ROUNDS):
        ctes += [assigned(f"at{k}", f"book{k}"), moved(f"book{k + 1}", f"book{k}", f"at{k}")]
    ctes.append(assigned("final", f"book{ROUNDS}"))
    ctes.append(f"""
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', CAST(de % {ENTRIES} AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(de // {ENTRIES}) AS BIGINT) AS error
  FROM final GROUP BY vec_id, label)""")
    ctes.append(f"""
digest AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(part) AS x, generate_subscripts(part, 1) AS i FROM book{ROUNDS}))""")
    return f"""WITH {",".join(ctes)}
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, digest"""


ORACLE = _sql()
