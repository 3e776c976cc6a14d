"""Best-fit packing by a grouping genetic algorithm.

`pieces` tokenizes whole texts, appends the end id and cuts only what is longer than a
sequence: the first piece takes the remainder, every other one is full. `pack` then puts
pieces into as few sequences as it can. A full piece is a sequence by itself; the others
are dealt evenly over blocks of about BLOCK pieces. Several islands work on each block:
each keeps a population of packings, the first by best-fit decreasing. Crossover injects
the best-filled bins of one parent into another, removes the bins that share a piece
with them, exchanges displaced pieces for smaller ones in bins with room, and puts the
rest back by best fit; an island that has reached the bound of its block, total length by
sequence, is done, as no packing has fewer. After each epoch the elite of
an island moves to the next one of its block by a join. At the end the bins of a block's
best packing that are too empty are opened, and their pieces go through the same again
in fewer blocks, until one block is left or nothing can be saved.

Only (piece, length) moves; tokens stay in the pieces table. A block is BLOCK small
numbers whatever the input, so no task or group grows with it.

Defined results: a null text is empty and gives one piece with the end id alone. An
empty table gives none. Repeated rows and null ids are packed as rows of their own. Texts
of any length are cut into pieces. Only the named columns are read, so others may have any
name.
"""

from __future__ import annotations

import bisect
import itertools
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundpanel.llm.common import UnitEncoder, staged, tidy

SEQUENCE, END_ID = 2048, 0
BLOCK, ISLANDS, POPULATION, EPOCHS, GENERATIONS = 4000, 2, 6, 2, 40
#: Pieces of a batch that a task sends on: some MB with their ids.
SENT = 500
#: Encoded units that a worker keeps, of those that may hold a special token.
KEPT_UNITS = 200_000
#: Displaced pieces that are tried in pairs, and pieces of a bin that are tried against them.
PAIRED, TRIED = 32, 8
#: A bin that is at least so full stays closed.
FULL = 0.995

def pieces(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", with_ids: bool = True,
           sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """(key, piece, start, length, ids_crc32, ids): one row per piece of each document."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = pa.from_numpy_dtype(np.int64)
    schema = f"key {rows.schema['key'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = UnitEncoder.of(tokenizer, KEPT_UNITS), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            at, out = [], []
            for i, t in enumerate(batch.column("text")):
                ids = coder.encode(t.as_py() or "") + end
                n, start, piece = len(ids) // 4, 0, 0
                size = n % sequence or sequence
                while start < n:
                    own = ids[4 * start:4 * (start + size)]
                    at.append(i)
                    out.append((piece, start, size, zlib.crc32(own), own))
                    start, size, piece = start + size, sequence, piece + 1
                    if len(out) == SENT:
                        yield sent(batch, at, out)
                        at, out = [], []
            yield sent(batch, at, out)

    def sent(batch: pa.RecordBatch, at: list[int], out: list[tuple]) -> pa.RecordBatch:
        p, s, n, c, own = zip(*out, strict=True) if out else ((),) * 5
        columns = [batch.column("key").take(pa.array(at, kind)), pa.array(p, pa.int32()), pa.array(s, kind), pa.array(n, kind), pa.array(c, kind)]
        names = ["key", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            ids = pa.array(np.frombuffer(b"".join(own), "<u4").astype(np.int32))
            places = pa.array(np.concatenate([[0], np.cumsum(n, dtype=np.int64)]).astype(np.int32))
            columns, names = [*columns, pa.ListArray.from_arrays(places, ids)], [*names, "ids"]
        return pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(cut, schema)


def best_fit(items: list[int], sizes: np.ndarray, room: int, bins: list[list[int]] | None = None, free: list[int] | None = None) -> tuple[list[list[int]], list[int]]:
    """Items by falling size into the fullest bin with room; bins and their free room."""
    bins, free = [list(b) for b in bins or []], list(free or [])
    order = sorted((f, k) for k, f in enumerate(free))
    for i in sorted(items, key=lambda i: -sizes[i]):
        s = int(sizes[i])
        at = bisect.bisect_left(order, (s, -1))
        if at == len(order):
            k = len(bins)
            bins.append([])
            free.append(room)
        else:
            k = order.pop(at)[1]
        bins[k].append(i)
        free[k] -= s
        bisect.insort(order, (free[k], k))
    return bins, free


def fitness(free: list[int], room: int) -> tuple[int, float]:
    """Fewer bins first, then uneven filling, which is easier to improve."""
    return -len(free), sum(((room - f) / room) ** 2 for f in free)


def exchange(bins: list[list[int]], free: list[int], displaced: list[int], sizes: list[int]) -> list[int]:
    """Fuller bins by exchanges: one or two items of a bin for one or two displaced ones that
    are larger together and fit. Fills the bins in place; what is displaced then."""
    singles = sorted((sizes[i], i) for i in displaced)
    few = singles[::-(-len(singles) // PAIRED)] if singles else []
    pairs = sorted((p + q, i, j) for (p, i), (q, j) in itertools.combinations(few, 2))
    for k, room in enumerate(free):
        if not room or not singles:
            continue
        own, best = bins[k], None
        for out in [(), *((i,) for i in own[:TRIED]), *itertools.combinations(own[:TRIED], 2)]:
            size = sum(sizes[i] for i in out)
            for others in (singles, pairs):
                at = bisect.bisect_right(others, (size + room, len(sizes))) - 1
                if at >= 0 and others[at][0] > size + (best[0] if best else 0):
                    best = others[at][0] - size, out, others[at][1:]
        if best:
            gain, out, into = best
            bins[k] = [i for i in own if i not in out] + [*into]
            free[k] = room - gain
            for i in into:
                singles.pop(bisect.bisect_left(singles, (sizes[i], i)))
            for i in out:
                bisect.insort(singles, (sizes[i], i))
            pairs = [p for p in pairs if p[1] not in into and p[2] not in into]  # the others are those of the start
    return [i for _, i in singles]


def crossover(a: tuple[list[list[int]], list[int]], b: tuple[list[list[int]], list[int]], sizes: np.ndarray, room: int, rng: random.Random) -> tuple[list[list[int]], list[int]]:
    """Well-filled bins of a go whole into b; b's bins that share an item with them are
    opened, with a few of its emptiest, and the displaced items are put back by exchanges
    and then by best fit."""
    full, share = sorted(range(len(a[0])), key=lambda k: a[1][k]), rng.uniform(0.01, 0.2)
    taken = [k for k in full[:max(1, len(full) // 2)] if rng.random() < share] or full[:1]
    inside = {i for k in taken for i in a[0][k]}
    emptiest = set(sorted(range(len(b[0])), key=lambda k: -b[1][k])[:max(2, len(b[0]) // 50)])
    bins, free, displaced = [a[0][k] for k in taken], [a[1][k] for k in taken], []
    for k, own in enumerate(b[0]):
        if k in emptiest or not inside.isdisjoint(own):
            displaced += [i for i in own if i not in inside]
        else:
            bins.append(own)
            free.append(b[1][k])
    return best_fit(exchange(bins, free, displaced, sizes.tolist()), sizes, room, bins, free)


def evolve(sizes: np.ndarray, room: int, seed: int, migrant: list[int] | None, start: list[int] | None) -> list[int]:
    """One epoch of one island: bin of each item in its best packing."""
    rng, everything = random.Random(seed), list(range(len(sizes)))

    def packing(of: list[int]) -> tuple[list[list[int]], list[int]]:
        bins: dict[int, list[int]] = {}
        for i, k in enumerate(of):
            bins.setdefault(k, []).append(i)
        own = list(bins.values())
        return own, [room - int(sum(sizes[i] for i in b)) for b in own]

    people = [packing(x) for x in (start, migrant) if x is not None]
    if not people:
        people = [best_fit(everything, sizes, room)]
    least = -(-int(sizes.sum()) // room)
    while min(len(p[0]) for p in people) > least and len(people) < POPULATION:
        noisy = sizes * (1 + np.array([rng.uniform(-0.1, 0.1) for _ in everything]))
        order = np.argsort(-noisy)
        bins, free = best_fit([int(i) for i in order[:len(order) // 2]], sizes, room)
        people.append(best_fit([int(i) for i in order[len(order) // 2:]], sizes, room, bins, free))
    for _ in range(GENERATIONS):
        people.sort(key=lambda p: fitness(p[1], room), reverse=True)
        if len(people[0][0]) <= least:
            break
        a, b = rng.sample(people[:POPULATION], 2)
        people = [*people[:POPULATION - 1], crossover(a, b, sizes, room, rng)]
    best = max(people, key=lambda p: fitness(p[1], room))
    out = [0] * len(sizes)
    for k, own in enumerate(best[0]):
        for i in own:
            out[i] = k
    return out


def _epoch(room: int, epoch: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("n").reset_index(drop=True)
        seed = int(group["block"][0]) * 1000 + int(group["island"][0]) * 10 + epoch
        had = lambda c: group[c].astype(int).tolist() if group[c].notna().all() else None
        group["own"] = evolve(group["size"].to_numpy(), room, seed, had("migrant"), had("own"))
        return group[["block", "island", "n", "size", "own"]]

    return run


def pack_sizes(items: DataFrame, room: int = SEQUENCE, block: int = BLOCK) -> DataFrame:
    """items (n long unique, size int <= room) to (n, bin string)."""
    done: DataFrame | None = None
    left = staged(items.select(F.col("n").cast("long").alias("n"), F.col("size").cast("int").alias("size")), "items")
    count, turn = left.count(), 0
    while count:
        blocks = -(-count // block)
        rows = left.withColumn("block", F.pmod(F.xxhash64("n", F.lit(turn)), F.lit(blocks)).cast("int"))
        state = (rows.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
                 .withColumn("own", F.lit(None).cast("int")).withColumn("migrant", F.lit(None).cast("int")))
        for epoch in range(EPOCHS):
            if epoch:
                elite = state.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), "n", F.col("own").alias("migrant"))
                state = state.join(elite, ["block", "island", "n"])
            state = staged(state.groupBy("block", "island").applyInPandas(_epoch(room, epoch), "block int, island int, n long, size int, own int"), "islands")
        best = (state.groupBy("block", "island").agg(F.countDistinct("own").alias("bins"))
                .groupBy("block").agg(F.min(F.struct("bins", "island")).alias("best")).select("block", "best.island"))
        solved = state.join(best, ["block", "island"]).select("n", "size", F.format_string("%d/%d/%d", F.lit(turn), "block", "own").alias("bin"))
        filled = solved.groupBy("bin").agg((F.sum("size") >= FULL * room).alias("full"))
        solved = staged(solved.join(filled, "bin"), "packed")
        again = solved.filter("not full").select("n", "size")
        rest = again.count()
        last = blocks == 1 or rest > 0.9 * count
        part = (solved if last else solved.filter("full")).select("n", "bin")
        done = part if done is None else done.union(part)
        left, count, turn = again, 0 if last else rest, turn + 1
    return done if done is not None else left.select("n", F.lit("").alias("bin"))


@tidy
def pack(parts: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """parts: rows with `length`, written before. Adds sequence_id and offset."""
    rows = staged(parts.withColumn("n", F.monotonically_increasing_id()), "pieces", "zstd")
    sizes = rows.select("n", F.col("length").alias("size"))
    bins = pack_sizes(sizes.filter(F.col("size") < sequence), sequence).withColumn("sequence_id", F.xxhash64("bin"))
    one = rows.filter(F.col("length") >= sequence).select("*", F.xxhash64(F.format_string("own/%d", "n")).alias("sequence_id"))
    # places are worked out on lengths; a piece moves with its tokens once, a full one never
    where = Window.partitionBy("sequence_id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    places = (bins.join(sizes, "n").withColumn("offset", F.coalesce(F.sum("size").over(where), F.lit(0)).cast("long"))
              .select("n", "sequence_id", "offset"))
    many = rows.filter(F.col("length") < sequence).join(places, "n")
    return many.drop("n").unionByName(one.withColumn("offset", F.lit(0).cast("long")).drop("n"))
