"""MinHash near-duplicates with tensored banding.

A table key of banded minhashing is the concatenation of some minhashes of a document's
set, and many tables are needed for a high recall. Here the keys are tensored: there are
COLLECTIONS left and as many right collections of HASHES minhashes each, and a table's key
combines one left with one right collection, so that COLLECTIONS ** 2 tables take
2 * COLLECTIONS * HASHES minhashes, where plain banding takes COLLECTIONS times as many.
Two sets with Jaccard similarity s meet in no table with a probability of at most
2 * (1 - s ** HASHES) ** COLLECTIONS: 4 in 100,000 at 0.85, and less beyond.

Work is kept in proportion to the corpus:

* documents with equal sets are one node, whatever their number, and a node's minhashes are
  worked out where its text is read;
* a collection's value that only one node has can be in no shared key, so the small
  collections are counted first, and only what is left of them is combined into keys;
* a table's bucket has a lead, the node with the smallest name, and every node is first
  held against one only, the smallest of its buckets' leads, so that a group gives no more
  pairs than it has nodes, whatever its number of tables. Linked nodes form components;
* buckets that then hold several components get other leads, STARS times, and only those
  that still do are looked at with the nodes of different components in pairs. A pair is
  made in the first table that both have, and no other. The parities of their sets' tokens
  in 64 * PARITIES classes are held against each other inside the join: at least as many
  tokens stand in one set only as parities differ, so what cannot link is left out exactly;
* of the pairs between two components one is verified first, as one link joins them, and
  the rest only where they are still apart.

Every candidate is verified on whole sets (64-bit hashes of shingles); sets are told apart
by 128-bit hashes. A pair that is not verified lies in one component, so components are
those of all links that meet in a table.

Defined results: documents without words (null, empty or white space) have empty sets,
link with nothing and are their own component. Fewer words than a shingle has are one
shingle. Texts of any length are taken whole, in blocks of tokens. Repeated rows and texts
with equal sets share a component. A null id is the largest: it names a component only
where all ids in it are null. Ties cannot occur, as components are named by their smallest
id. An empty table gives an empty table. Only the two named columns are read, so others
may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundpanel.llm.common import components, in_sketch, key_sketch, staged
from fundpanel.llm.ngram_join import shingles

WORDS, PERCENT = 5, 85
COLLECTIONS, HASHES = 12, 3
PARITIES = 8
#: Tokens of a set that are hashed at a time.
BLOCK = 8192
#: Bits of the largest set of wanted names that tasks get, as a power of two.
MOST_BITS = 26
#: Further leads that a bucket with several components gets before its pairs are made.
STARS = 2
#: How many pairs of two components are verified in a round; None: all that are left.
ROUNDS = (1, None)
Batches = Iterator[pa.RecordBatch]


def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed odd factors and masks of the hash functions."""
    draw = np.random.default_rng(12).integers(0, 1 << 63, (2, count), dtype=np.int64).astype(np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def minhashes(tokens: np.ndarray, count: int) -> np.ndarray:
    """The least value of each of `count` hash functions over a set's 64-bit tokens."""
    factors, masks = _multipliers(count)
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(tokens), BLOCK):
        x = (tokens[at:at + BLOCK].astype(np.int64).view(np.uint64)[:, None] ^ masks) * factors
        least = np.minimum(least, (x ^ (x >> np.uint64(32))).min(axis=0))
    return least


def collections_of(tokens: np.ndarray, collections: int = COLLECTIONS, hashes: int = HASHES) -> np.ndarray:
    """Values of the left and then the right collections, one 64-bit number each."""
    low = minhashes(tokens, 2 * collections * hashes).reshape(2 * collections, hashes)
    return np.array([xxhash.xxh3_64_intdigest(row.tobytes(), seed=k) for k, row in enumerate(low)], np.uint64).view(np.int64)


def parities(tokens: np.ndarray) -> np.ndarray:
    """Whether each of 64 * PARITIES classes has an odd number of tokens, as 64-bit words."""
    odd = np.bincount(tokens & (64 * PARITIES - 1), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def name_of(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def described(docs: DataFrame, text: str, key: str, words: int, collections: int, hashes: int) -> DataFrame:
    """(key, n, node, small, bits) of every document: set size, the set's name, values of its
    collections and parities. The last three are null for empty sets, and the last two are
    not written again for a set that the task has met."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, n long, node binary, small array<long>, bits array<long>"

    def run(batches: Batches) -> Batches:
        seen: set[bytes] = set()
        for batch in batches:
            n, node, small, bits = [], [], [], []
            for t in batch.column("text"):
                s = shingles(t.as_py(), words)
                own = name_of(s) if len(s) else None
                new = own is not None and own not in seen
                n.append(len(s))
                node.append(own)
                small.append(collections_of(s, collections, hashes) if new else None)
                bits.append(parities(s) if new else None)
                if new and len(seen) < 1_000_000:
                    seen.add(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(small, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
                ["key", "n", "node", "small", "bits"])

    return rows.mapInArrow(run, schema)


def buckets_of(nodes: DataFrame, collections: int = COLLECTIONS) -> DataFrame:
    """(bucket, left, right, node) of the table keys of collections that two nodes or more
    have; left and right are the places of the two collections. nodes: (node, small)."""
    single = nodes.select("node", F.posexplode("small").alias("place", "value"))
    shared = single.groupBy("place", "value").count().filter("count > 1").drop("count")
    left = F.filter("own", lambda x: x["place"] < collections)
    right = F.filter("own", lambda x: x["place"] >= collections)
    keys = F.flatten(F.transform(left, lambda x: F.transform(right, lambda y: F.struct(
        F.xxhash64(x["place"], x["value"], y["place"], y["value"]).alias("bucket"), x["place"].cast("short").alias("left"), y["place"].cast("short").alias("right")))))
    met = single.join(shared, ["place", "value"]).groupBy("node").agg(F.collect_list(F.struct("place", "value")).alias("own"))  # 2 * collections at most
    return staged(met.select("node", F.explode(keys).alias("k")).select("k.bucket", "k.left", "k.right", "node"), "keys")


def _sizes(percent: int) -> Column:
    """Whether sets of n1 and n2 tokens can link at all."""
    return F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * percent


def _alike(percent: int) -> Column:
    """Whether no more parities differ than linked sets of these sizes have tokens apart."""
    least = F.ceil((F.col("n1") + F.col("n2")) * percent / (100 + percent) - F.lit(1e-9))
    apart = sum((F.bit_count(F.col("bits1")[k].bitwiseXOR(F.col("bits2")[k])) for k in range(PARITIES)), F.lit(0))
    return apart <= F.col("n1") + F.col("n2") - 2 * least


def _first_met(a: str, b: str, places: range) -> Column:
    """The first of some collections in which two nodes agree."""
    return F.coalesce(*[F.when(F.col(a)[k] == F.col(b)[k], k) for k in places])


def _ends(nodes: DataFrame, end: str, k: int) -> DataFrame:
    return nodes.select(F.col("node").alias(end), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"bits{k}"))


def whole_sets(docs: DataFrame, text: str, nodes: DataFrame, words: int) -> DataFrame:
    """(node, tokens) of some nodes, worked out again where the texts are read, and kept.
    A bit set over the wanted names, sized by their count and bounded by MOST_BITS, says
    which sets to send; as it fills up, sets that nobody wants are sent too, and lost in
    the joins. Equal sets of a task are sent once."""
    wanted = staged(nodes.select(F.xxhash64("node").alias("h")), "wanted")
    sketch = key_sketch(wanted, "h", bits=min(MOST_BITS, max(16, (16 * wanted.count()).bit_length())))

    def run(batches: Batches) -> Batches:
        bits, seen = np.frombuffer(sketch, np.uint32), set()
        for batch in batches:
            out: list[tuple[bytes, bytes]] = []
            for t in batch.column("text"):
                s = shingles(t.as_py(), words)
                own = name_of(s)
                if len(s) and own not in seen and in_sketch(bits, np.array([xxhash.xxh64_intdigest(own, seed=42)], np.uint64).view(np.int64))[0]:
                    seen.add(own)
                    out.append((own, s.tobytes()))
                if len(out) == 200:
                    yield _batch_of_sets(out)
                    out = []
            yield _batch_of_sets(out)

    sent = docs.select(F.col(text).alias("text")).mapInArrow(run, "node binary, tokens binary")
    return staged(sent.groupBy("node").agg(F.first("tokens").alias("tokens")), "sets")


def _batch_of_sets(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)], ["node", "tokens"])


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link. Sets move to their name, and from there each
    b's once to its a."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    members = pairs.join(sets.withColumnsRenamed({"node": "b", "tokens": "y"}), "b")
    leads = sets.join(pairs.select(F.col("a").alias("node")).distinct(), "node", "left_semi").withColumnsRenamed({"node": "a", "tokens": "x"})
    both = members.join(leads, "a").select("a", "b", "x", "y")
    return staged(both.mapInArrow(run, "a binary, b binary"), "links")


def _placed(rows: DataFrame, comps: DataFrame, column: str, out: str) -> DataFrame:
    """With the component of a node; nodes without a link are their own."""
    of = comps.select(F.col("node").alias(column), F.col("component").alias(out))
    return rows.join(of, column, "left").withColumn(out, F.coalesce(out, column))


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after more links: only the components that they join are walked."""
    ends = _placed(_placed(links, comps, "a", "x"), comps, "b", "y")
    ends = staged(ends.select("a", "b", "x", "y"), "ends")
    if ends.isEmpty():
        return comps
    joined = components(ends.filter("x <> y").select("x", "y"), "x", "y")
    own = [F.struct(F.col(n).alias("node"), F.col(c).alias("component")) for n, c in (("a", "x"), ("b", "y"))]
    every = comps.union(ends.select(F.explode(F.array(*own)).alias("n")).select("n.*")).distinct()
    return staged(_placed(every.select("node", F.col("component").alias("was")), joined, "was", "component").select("node", "component"), "components")


def similar(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, percent: int = PERCENT,
            collections: int = COLLECTIONS, hashes: int = HASHES) -> DataFrame:
    """(key, n, component): set size and the smallest key reachable by links, one row per
    document."""
    rows = staged(described(docs, text, key, words, collections, hashes), "described")
    nodes = staged(rows.filter("small is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("small").alias("small"), F.first("bits").alias("bits")), "nodes")
    keys = buckets_of(nodes, collections)
    leads = keys.groupBy("bucket").agg(F.min("node").alias("lead"), F.count("*").alias("size")).filter("size > 1").drop("size")
    members = staged(keys.join(leads, "bucket"), "members")
    sets = whole_sets(docs, text, members.select("node").distinct(), words)

    near, alike = _sizes(percent), _alike(percent)

    def from_leads(rows: DataFrame) -> DataFrame:
        pairs = rows.filter("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
        return pairs.join(_ends(nodes, "b", 2), "b").join(_ends(nodes, "a", 1), "a").filter(near & alike).select("a", "b")

    one = members.filter("node <> lead").groupBy("node").agg(F.min("lead").alias("lead"))
    comps = components(linked(from_leads(one), sets, percent))
    open_ = members.drop("lead")
    for star in range(STARS + 1):
        placed = staged(_placed(open_, comps, "node", "component"), "placed")
        mixed = placed.groupBy("bucket").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.min_by(F.struct("node", "component"), F.xxhash64("node", F.lit(star))).alias("lead")).filter("low <> high")
        open_ = staged(placed.join(mixed.select("bucket", F.col("lead.node").alias("lead"), F.col("lead.component").alias("of")), "bucket"), "open")
        if star < STARS:
            comps = _merged(comps, linked(from_leads(open_.filter("component <> of")), sets, percent))
            open_ = open_.drop("component", "lead", "of")

    about = open_.drop("lead", "of").join(nodes, "node")
    a, b = (about.withColumnsRenamed({"node": end, "component": f"c{k}", "n": f"n{k}", "bits": f"bits{k}", "small": f"small{k}"}) for k, end in ((1, "a"), (2, "b")))
    once = (F.col("left") == _first_met("small1", "small2", range(collections))) & (F.col("right") == _first_met("small1", "small2", range(collections, 2 * collections)))
    pairs = a.join(b.drop("left", "right"), "bucket").filter((F.col("a") < F.col("b")) & (F.col("c1") != F.col("c2")) & near & alike & once)
    left = staged(pairs.select("a", "b"), "pairs")
    for most in ROUNDS:
        apart = _placed(_placed(left, comps, "a", "c1"), comps, "b", "c2").filter("c1 <> c2")
        ends = Window.partitionBy(F.least("c1", "c2"), F.greatest("c1", "c2")).orderBy("a", "b")
        tried = apart if most is None else apart.withColumn("place", F.row_number().over(ends)).filter(F.col("place") <= most)
        tried = staged(tried.select("a", "b"), "tried")
        if tried.isEmpty():
            break
        left = left.join(tried, ["a", "b"], "left_anti")
        comps = _merged(comps, linked(tried, sets, percent))

    own = rows.select("key", "n", "node")
    least = _placed(own.filter("n > 0").groupBy("node").agg(F.min("key").alias("low")), comps, "node", "group")
    ids = least.groupBy("group").agg(F.min("low").alias("id"))
    named = least.join(ids, "group").select("node", "id")
    return own.join(named, "node", "left").select("key", "n", F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("id")).alias("component"))


def oracle(words: int, percent: int) -> str:
    """The same links in DuckDB's SQL, found by pairs of rows that share a shingle."""
    return rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_sort(list_distinct(list_transform(range(len(w) - {words} + 1), lambda i: list_aggregate(w[i + 1:i + {words}], 'string_agg', ' ')))) END AS s
  FROM texts),
named AS (SELECT doc_id, len(s) AS n, CASE WHEN len(s) > 0 THEN md5(list_aggregate(s, 'string_agg', chr(10))) END AS node, s FROM sets),
nodes AS (SELECT node, any_value(n) AS n, any_value(s) AS s FROM named WHERE node IS NOT NULL GROUP BY node),
tokens AS (SELECT node, n, unnest(s) AS t FROM nodes),
repeated AS (SELECT t FROM tokens GROUP BY t HAVING count(*) > 1),
links AS (
  SELECT a.node AS x, b.node AS y
  FROM (SELECT * FROM tokens JOIN repeated USING (t)) AS a JOIN (SELECT * FROM tokens JOIN repeated USING (t)) AS b ON a.t = b.t AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
ends AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT node AS x, node AS y FROM nodes UNION SELECT r.x, e.y FROM reach AS r JOIN ends AS e ON r.y = e.x),
low AS (SELECT node, min(doc_id) AS low FROM named WHERE node IS NOT NULL GROUP BY node),
ids AS (SELECT r.x AS node, min(low) AS component_id FROM reach AS r JOIN low ON low.node = r.y GROUP BY r.x)
SELECT doc_id, n AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
FROM named LEFT JOIN ids USING (node)
"""


ORACLE = oracle(WORDS, PERCENT)
