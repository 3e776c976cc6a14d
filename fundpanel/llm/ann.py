"""Approximate nearest neighbours by an inverted multi-index.

A vector's two halves are quantised separately, each by its own codebook of CENTROIDS
centroids fitted to a bounded sample of rows; a cell is a pair of centroids. For a query
the cells are visited by a heap in the order of the summed score of the two centroids
(inner product), until the visited cells hold the wanted share of all entries and, as
far as there are, k + 1 different ids. Entries of visited cells, and only they, are
reranked on their original vectors.

The share is calibrated: CALIBRATE sampled queries are searched exactly against all
rows, in blocks, and the share is the smallest that would have found TARGET of their
neighbours. So recall holds for vectors without structure too, at the price of visiting
more.

Equal vectors are one entry that holds the smallest k + 1 ids, which is all that any
result can show; a vector with very many copies is one row. Entries are dealt evenly
over blocks of BLOCK by a hash, queries over chunks; each (block, chunk) is one task's
work, in which a query's best k are kept, and the best of its blocks are merged.

Defined results: vectors that are null, empty, zero, of another length than most, or
hold null or non-finite components take no part, neither do null ids. A row never finds
its own id. Ids that stand on several rows are shown once, with their best score. Fewer
candidates than k give fewer rows. Ties go to the smaller id. An empty table, or one without
a usable vector, gives no rows. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundpanel.llm.common import staged

CENTROIDS, SAMPLE, STEPS = 32, 16_384, 12
BLOCK, CHUNK = 16_384, 4_096
CALIBRATE, TARGET = 192, 0.97
#: Ids per list while copies are merged, level by level.
FAN = 4_096


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    v = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def entries(vectors: DataFrame, vector: str, key: str, k: int) -> DataFrame:
    """(entry, vector, ids): distinct vectors with their k + 1 smallest ids. Only hashes
    and ids are shuffled to merge copies, in lists of FAN ids at most a level."""
    v = F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0))  # -0.0 is 0.0
    rows = (vectors.filter(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), v.alias("vector"))
            .withColumn("entry", F.xxhash64("vector")))
    least = lambda ids: F.slice(F.array_sort(F.array_distinct(ids)), 1, k + 1)
    level = rows.select("entry", F.array("id").alias("ids"), F.floor(F.col("id") / FAN).alias("part"))
    for _ in range(2):
        level = level.groupBy("entry", "part").agg(least(F.flatten(F.collect_list("ids"))).alias("ids")).withColumn("part", F.floor(F.col("part") / FAN))
    merged = level.groupBy("entry").agg(least(F.flatten(F.collect_list("ids"))).alias("ids"))
    lead = merged.select("entry", "ids", F.col("ids")[0].alias("id"))
    return lead.join(rows, ["entry", "id"]).groupBy("entry").agg(F.first("vector").alias("vector"), F.first("ids").alias("ids"))


def kmeans(x: np.ndarray, centroids: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(centroids, len(x)), replace=False)].copy()
    for _ in range(STEPS):
        at = (x @ c.T - 0.5 * (c**2).sum(axis=1)).argmax(axis=1)
        for j in range(len(c)):
            own = x[at == j]
            c[j] = own.mean(axis=0) if len(own) else x[rng.integers(len(x))]
    return c


class Codebooks:
    """Two codebooks, for the first and the second half of the components."""

    def __init__(self, sample: np.ndarray, centroids: int = CENTROIDS) -> None:
        self.half = sample.shape[1] // 2
        self.books = [kmeans(sample[:, :self.half], centroids, 1), kmeans(sample[:, self.half:], centroids, 2)]
        self.cells = len(self.books[0]) * len(self.books[1])

    def cell(self, x: np.ndarray) -> np.ndarray:
        a, b = (((p @ c.T) - 0.5 * (c**2).sum(axis=1)).argmax(axis=1) for p, c in zip((x[:, :self.half], x[:, self.half:]), self.books, strict=True))
        return a * len(self.books[1]) + b

    def visit(self, query: np.ndarray) -> Iterator[int]:
        """Cells from the nearest on: a heap over pairs of ranks in the two sorted lists."""
        scores = [c @ q for q, c in zip((query[:self.half], query[self.half:]), self.books, strict=True)]
        order = [np.argsort(-s, kind="stable") for s in scores]
        a, b = (s[o].tolist() for s, o in zip(scores, order, strict=True))
        heap, reached = [(-(a[0] + b[0]), 0, 0)], [-1] * len(a)
        reached[0] = 0
        while heap:
            _, i, j = heapq.heappop(heap)
            yield int(order[0][i]) * len(b) + int(order[1][j])
            # a pair is queued when the one before it in its row and in its column is out
            if j + 1 < len(b):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(np.float64)


def _best(scores: np.ndarray, ids: list[np.ndarray], k: int, own: int) -> list[tuple[float, int]]:
    """The best k (score, id) of entries; own is left out."""
    top = np.argpartition(-scores, k)[:k + 1] if len(scores) > k + 1 else np.arange(len(scores))
    last = scores[top].min(initial=np.inf)
    top = np.flatnonzero(scores >= last) if np.isfinite(last) else top[np.isfinite(scores[top])]
    found = [(float(scores[e]), int(i)) for e in top for i in ids[e] if i != own]
    return sorted(found, key=lambda x: (-x[0], x[1]))[:k]


def search(vectors: DataFrame, queries: DataFrame, vector: str = "embedding", key: str = "vec_id", k: int = 20,
           centroids: int = CENTROIDS, target: float = TARGET) -> DataFrame:
    """(query_id, rank, id, score) of the k entries with the largest inner product found.
    queries: rows of the same form; a query's own id is no candidate."""
    spark = vectors.sparkSession
    sizes = vectors.filter(usable(F.col(vector))).groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, id long, score double")
    if not sizes:
        return empty
    width = F.size(vector) == sizes[0]["n"]
    base = staged(entries(vectors.filter(width), vector, key, k), "entries")
    total = base.count()
    if not total:
        return empty
    hashed = F.xxhash64("entry", F.lit(3))
    bound = F.lit(min(1.0, SAMPLE / total)) * float(1 << 40)
    sample = base.filter(F.pmod(hashed, F.lit(1 << 40)) < bound).select("vector").limit(2 * SAMPLE).toPandas()["vector"]
    sample = sample if len(sample) else base.select("vector").limit(1).toPandas()["vector"]
    books = Codebooks(_matrix(sample), centroids)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("vector")
            x = x.values.to_numpy()[x.offsets[0].as_py():x.offsets[-1].as_py()].reshape(batch.num_rows, -1)
            yield batch.append_column("cell", pa.array(books.cell(x).astype(np.int32)))

    blocks = -(-total // BLOCK)
    index = staged(base.mapInArrow(cells, "entry long, vector array<double>, ids array<long>, cell int")
                   .withColumn("block", F.pmod(F.xxhash64("entry"), F.lit(blocks)).cast("int")), "index")
    # the k + 1 smallest ids of each cell: which are enough to tell whether there are k + 1
    few = (index.select("cell", F.explode("ids").alias("id")).distinct()
           .withColumn("n", F.row_number().over(Window.partitionBy("cell").orderBy("id"))).filter(F.col("n") <= k + 1))
    ids_of: dict[int, list[int]] = {}
    for c, i in few.select("cell", "id").collect():  # k + 1 for each cell at most
        ids_of.setdefault(c, []).append(i)
    counts = np.zeros(books.cells, np.int64)
    for c, n in index.groupBy("cell").count().collect():  # cells of the index at most
        counts[c] = n

    asked = staged(queries.filter(F.col(key).isNotNull() & usable(F.col(vector)) & width)
                   .select(F.col(key).cast("long").alias("query_id"), F.transform(F.col(vector), lambda x: x.cast("double")).alias("query")).distinct(), "queries")

    def placed(share: float):
        """Bits of the cells that a query visits, as bytes."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for q in batch.column("query"):
                    marks, held, ids = np.zeros(books.cells, bool), 0, set()
                    for c in books.visit(q.values.to_numpy()):
                        marks[c] = True
                        held += counts[c]
                        if len(ids) <= k:
                            ids.update(ids_of.get(c, ()))
                        if held >= share * total and len(ids) > k:
                            break
                    out.append(np.packbits(marks).tobytes())
                yield batch.append_column("cells", pa.array(out, pa.binary()))

        return run

    def rerank(entries_of: pd.DataFrame, queries_of: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(entries_of) and len(queries_of):
            entries_of = entries_of.sort_values("cell")
            x, ids = _matrix(entries_of["vector"]), entries_of["ids"].to_list()
            present, starts = np.unique(entries_of["cell"].to_numpy(), return_index=True)
            ends = np.append(starts[1:], len(x))
            for a in range(0, len(queries_of), 128):
                part = queries_of.iloc[a:a + 128]
                q = _matrix(part["query"])
                marks = np.unpackbits(np.stack([np.frombuffer(c, np.uint8) for c in part["cells"]]), axis=1)
                scores = np.full((len(q), len(x)), -np.inf)
                for c, s, e in zip(present, starts, ends, strict=True):
                    who = np.flatnonzero(marks[:, c])
                    if len(who):
                        scores[who, s:e] = q[who] @ x[s:e].T
                for own, row, one in zip(part["query_id"], scores, q, strict=True):
                    found = _best(row, ids, k, own)
                    exact = {i: None for _, i in found}
                    for e in np.flatnonzero(row >= (found[-1][0] if found else np.inf)):
                        value = float((x[e] * one).sum())
                        for i in ids[e]:
                            if i in exact and (exact[i] is None or value > exact[i]):
                                exact[i] = value
                    out += [(own, i, v) for i, v in exact.items()]
        return pd.DataFrame(out, columns=["query_id", "id", "score"])

    def found(asked_of: DataFrame, share: float) -> DataFrame:
        n = asked_of.count()
        chunks = max(1, -(-n // CHUNK))
        marked = asked_of.mapInArrow(placed(share), "query_id long, query array<double>, cells binary")
        left = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        right = marked.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        near = (left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk"))
                .applyInPandas(lambda e, q: rerank(e, q), "query_id long, id long, score double"))
        best = near.groupBy("query_id", "id").agg(F.max("score").alias("score"))
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")

    share = calibrated(asked, index, books, counts, total, found, target, k)
    return found(asked, share)


def calibrated(asked: DataFrame, index: DataFrame, books: Codebooks, counts: np.ndarray, total: int, found, target: float, k: int) -> float:
    """The share of entries to visit, from exact searches of a few queries."""
    some = staged(asked.orderBy(F.xxhash64("query_id", F.lit(5)), "query_id").limit(CALIBRATE), "sampled")
    exact = found(some, 2.0)
    cell = index.select(F.explode("ids").alias("id"), "cell").groupBy("id").agg(F.min("cell").alias("cell"))
    true: dict[int, list[int]] = {}
    for q, c in exact.join(cell, "id").select("query_id", "cell").collect():  # CALIBRATE * k rows at most
        true.setdefault(q, []).append(c)
    needed = []
    for row in some.collect():
        held, wanted = 0, set(true.get(row["query_id"], []))
        for c in books.visit(np.array(row["query"])):
            if not wanted:
                break
            held += int(counts[c])
            if c in wanted:
                wanted.discard(c)
                needed += [held / total] * true[row["query_id"]].count(c)
    return float(np.quantile(needed, target)) if needed else 1.0
