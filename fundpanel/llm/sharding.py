"""Sharding by balanced label propagation.

Documents that stand in a common group (here: equal texts) are linked through the
group, so a group of n documents has n links and not n * n. Every document starts in the
shard that a hash of its row names. In each round a group's members want to go where
most of them are, full shards and those in them aside; how many may go into a shard is
limited by its quota, the rows of an even share less those that want to stay. Where more want to come, a hash picks whole groups, or
single rows of a group that is large against a shard. So a group larger than a shard
fills one after the other. Rounds end when nobody wants to move, or after ROUNDS.

Then the law `rows` is made exact: counts differ by one at most. Rows beyond a shard's
count leave it, ungrouped ones first, and fill the others in the order of their groups,
so that few groups are cut.

Rounds are joins and counts by (group, shard); the driver sees the counts of the shard
pairs, SHARDS * SHARDS numbers. Rows are numbered by buckets, never in one task for a
shard or a group.

Defined results: a null text has no bytes, so its size is 1; it is in one group with
empty texts. Repeated rows are rows of their own, in one group. An empty table gives none.
Of a text only its length and hash are kept, whatever its length. Only the named columns
are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundpanel.llm.common import numbered, staged

SHARDS, ROUNDS = 16, 10
#: A group with more than this part of a shard's rows moves row by row.
LARGE = 0.125
#: A shard with this part of its rows in linked ones takes no more.
FULL = 0.98
LAW = "rows"


def _unit(*columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) / float(1 << 40)


def propagate(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """rows: (row long unique, hub long). Adds shard; shards are nearly even only.
    Rows whose hub no other row has never move."""
    total = rows.count()
    share = total / shards
    sizes = rows.groupBy("hub").agg(F.count("*").alias("hub_rows"))
    state = staged(rows.join(sizes, "hub").withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")), "labels")
    full: list[int] = []
    for k in range(rounds):
        votes = state.filter((F.col("hub_rows") > 1) & ~F.col("shard").isin(*full, -1)).groupBy("hub", "shard").agg(F.count("*").alias("votes"))
        most = (votes.groupBy("hub").agg(F.max(F.struct("votes", F.xxhash64("hub", "shard").alias("tie"), "shard")).alias("m"))
                .select("hub", F.col("m.shard").alias("goal")))
        wished = staged(votes.join(most, "hub"), "wishes")
        flows = wished.groupBy("shard", "goal").agg(F.sum("votes").alias("n")).collect()
        if not any(f["shard"] != f["goal"] for f in flows):
            break
        parts, filled = {}, []
        for t in range(shards):
            come = sum(f["n"] for f in flows if f["goal"] == t != f["shard"])
            stay = sum(f["n"] for f in flows if f["goal"] == t == f["shard"])
            room = max(0.0, share - stay)
            parts[t] = 1.0 if come <= room else room / come
            if stay + come * parts[t] >= FULL * share:
                filled.append(t)
        quota = F.element_at(F.create_map(*[F.lit(x) for t, p in parts.items() for x in (t, p)]), F.col("goal"))
        pick = F.when(F.col("hub_rows") > LARGE * share, _unit(F.col("row"), F.lit(k))).otherwise(_unit(F.col("hub"), F.lit(k)))
        moves = F.col("goal").isNotNull() & ~F.col("shard").isin(*full, -1) & (pick < quota)
        moved = state.join(wished.select("hub", "goal").distinct(), "hub", "left").withColumn("shard", F.when(moves, F.col("goal")).otherwise(F.col("shard")))
        state = staged(moved.select(state.columns), "labels")
        full += filled
    return state


def evened(state: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(row, hub, shard) with counts at most one apart."""
    held = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    total = sum(held.values())
    # the shards that hold most get the counts that are one larger
    order = sorted(range(shards), key=lambda s: (-held.get(s, 0), s))
    want = {s: total // shards + (1 if k < total % shards else 0) for k, s in enumerate(order)}
    limit = F.element_at(F.create_map(*[F.lit(x) for s, n in want.items() for x in (s, n)]), F.col("shard"))
    # single rows have the last numbers, and the groups' rows follow each other
    single = (F.col("hub_rows") == 1).cast("long")
    ranked = numbered(state, "shard", F.struct(single.alias("s"), "hub", "row"), "rank", first=F.col("hub_rows") == 1)
    ranked = staged(ranked.select("row", "hub", "hub_rows", "shard", "rank"), "ranked")
    over = ranked.filter(F.col("rank") >= limit).withColumn("one", F.lit(0))
    over = numbered(over, "one", F.struct("hub", "row"), "place", spread=F.col("hub_rows") > LARGE * total / shards)
    at, start = F.lit(None).cast("int"), 0
    for s in range(shards):
        need = want[s] - min(want[s], held.get(s, 0))
        if need:
            at = F.when((F.col("place") >= start) & (F.col("place") < start + need), F.lit(s)).otherwise(at)
            start += need
    return ranked.filter(F.col("rank") < limit).select("row", "hub", "shard").union(over.select("row", "hub", at.alias("shard")))


def shard(docs: DataFrame, text: str = "text", key: str = "doc_id", shards: int = SHARDS) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot) of every document."""
    own = F.coalesce(F.col(text), F.lit(""))
    rows = staged(docs.select(F.col(key).alias("key"), (F.octet_length(own) + 1).cast("long").alias("size"), F.crc32(own).alias("text_crc32"), F.xxhash64(own).alias("hub"))
                  .withColumn("row", F.monotonically_increasing_id()), "rows")
    placed = evened(propagate(rows.select("row", "hub"), shards), shards)
    slots = numbered(placed.select("row", "shard"), "shard", F.col("row"), "slot")
    return rows.join(slots, "row").select("key", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot")
