"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds the hashes of its distinct word shingles. Two sets link when
100 * |intersection| >= percent * |union|. Tokens have one global order: those counted
often come last, by count, all others by hash. With s the least overlap that a set of n
tokens can link with, its l-prefix is its first n - s + l tokens in that order, and two
sets that link share at least min(l, m) tokens of an l- and an m-prefix. Every document
picks its own l: a longer prefix costs more rows, but asks for more shared tokens, so a
document whose prefix holds frequent tokens takes a larger l, by estimated cost.

Large groups cost no more than their size:

* documents with equal sets are one node, whatever their number;
* in a prefix token's list every node is first held against one lead only: the node with
  the smallest part of tokens that no other set has, as the original of many edited copies
  is nearer to each than they are to each other. Nodes that link form components. Then
  only nodes of different components are paired, and lists that lie within one component
  are left out altogether;
* of a pair only tokens are joined that stand in the short prefixes which sets of these
  two sizes need (a stored prefix is long enough for the smallest partner), so outliers of
  a large group, whose first tokens are their own, do not meet its members in every list;
* these pairs are first held against the parities of their sets' tokens in 64 * PARITIES
  classes: as many tokens at least stand in one set only as parities differ, so pairs
  with more differences than linked sets can have are left out before they are counted;
* lists of tokens counted HOT times or more are dealt over SALTS parts, and the leads of
  the parts give the list's lead;
* of the pairs between two components the one with most shared tokens is verified first,
  as one link joins them. Where it does not link, more are, and in the end all.

A pair that is not verified lies in one component, so components are those of all links.

The order is a matter of cost only: any order gives the same links. Counts come from all
documents: tokens that stand in at least OFTEN different sets of a batch are summed over
batches, and the HEAVY most frequent are kept, which bounds what every task gets.
Candidates are verified on their whole sets. Nodes are told apart by 64-bit hashes,
tokens in verification by 48 bits.

Defined results: documents without words (null, empty or white space) have empty sets,
link with nothing and are their own component. Repeated rows have equal sets. A null id
is never a component's id unless all ids in it are null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundpanel.llm.common import components, fresh, in_sketch, key_sketch, staged, tidy

WORDS, PERCENT = 5, 75
OFTEN, HEAVY, MOST_MATCHES = 2, 1 << 19, 4
HOT, SALTS = 10_000, 64
PARITIES = 4
BITS = [f"bits{k}" for k in range(PARITIES)]
#: How many pairs of two components are verified in a round; None: all that are left.
ROUNDS = (1, 16, None)
#: What one candidate costs against one row of the index.
VERIFY = 20.0
#: Pairs are counted on as much of what their prefixes have beyond the least they need.
BEYOND = 0.25


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a whole text's shingles. Words are cut at ASCII
    white space, A to Z in lower case; fewer words than a shingle has are one shingle."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII rules
    n = len(parts)
    if not n:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, n)
    size = min(words, n)
    out = np.full(n - size + 1, size if n < words else 0, np.uint64)
    for k in range(size):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:n - size + 1 + k])
    return np.unique(out.view(np.int64))


def signature(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def parities(tokens: np.ndarray) -> np.ndarray:
    """Whether each of 64 * PARITIES classes has an odd number of tokens, as 64-bit words."""
    odd = np.bincount(tokens & (64 * PARITIES - 1), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def counted(tokens: np.ndarray, heavy: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each token was counted, 1 if it is not among the sorted heavy ones."""
    if not len(heavy):
        return np.ones(len(tokens), np.int64)
    at = np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)
    return np.where(heavy[at] == tokens, counts[at], 1)


def prefix(tokens: np.ndarray, heavy: np.ndarray, counts: np.ndarray, percent: int = PERCENT, most: int = MOST_MATCHES) -> tuple[np.ndarray, int]:
    """(tokens of the chosen l-prefix, l). heavy: sorted tokens, counts: theirs."""
    at, choice = prefix_places(tokens, counted(tokens, heavy, counts), percent, most)
    return tokens[at], choice


def prefix_places(tokens: np.ndarray, often: np.ndarray, percent: int, most: int = MOST_MATCHES) -> tuple[np.ndarray, int]:
    n = len(tokens)
    least = -(-percent * n // 100)
    order = np.lexsort((tokens, often))
    cost = np.cumsum(often[order] - 1)
    best, choice = None, 1
    for m in range(1, min(most, least) + 1):
        size = n - least + m
        price = size + VERIFY * cost[size - 1] / m**2
        if best is None or price < best:
            best, choice = price, m
    return order[:n - least + choice], choice


Batches = Iterator[pa.RecordBatch]


def _sets(batches: Batches, words: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        yield batch, [shingles(t.as_py(), words) for t in batch.column("text")]


def signed(docs: DataFrame, text: str, key: str, words: int) -> DataFrame:
    """(kind 0, key, n, sig, whole, BITS) of every document, whole: a hash of its text; (kind
    1, token as sig, count as n) of the tokens that are frequent in a batch."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("whole"))
    schema = f"kind int, key {rows.schema['key'].dataType.simpleString()}, n long, sig long, whole long, " + ", ".join(f"{b} long" for b in BITS)
    names = ["kind", "key", "n", "sig", "whole", *BITS]

    def run(batches: Batches) -> Batches:
        for batch, sets in _sets(batches, words):
            keys = batch.column("key")
            odd = np.array([parities(s) for s in sets], np.int64).reshape(-1, PARITIES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(sets), np.int32)), keys, pa.array([len(s) for s in sets], pa.int64()), pa.array([signature(s) for s in sets], pa.int64()), batch.column("whole"), *[pa.array(x) for x in odd.T]], names)
            if sets:
                distinct = {signature(s): s for s in sets}
                tokens, counts = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
                tokens, counts = tokens[counts >= OFTEN], counts[counts >= OFTEN]
                none = pa.nulls(len(tokens), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(tokens), np.int32)), pa.nulls(len(tokens), keys.type), pa.array(counts), pa.array(tokens), none, *[none] * PARITIES], names)

    return rows.mapInArrow(run, schema)


def postings(docs: DataFrame, text: str, heavy: np.ndarray, counts: np.ndarray, words: int, percent: int) -> DataFrame:
    """(token, salt, sig, n, l, rare, at) for the prefix tokens of every set; one that a task
    has seen is not written again. salt: part of a hot token's list, 0 for all others;
    rare: tokens of the set that were not counted often, in thousandths; at: the token's
    place in the set's order, from 0."""
    hot, salts_of = HOT, SALTS

    def run(batches: Batches) -> Batches:
        seen: set[int] = set()
        for _, sets in _sets(batches, words):
            tokens, salts = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
            places = [np.zeros(0, np.int32)]
            sigs, sizes, matches, rare, lengths = [], [], [], [], []
            for s in sets:
                sig = signature(s)
                if not len(s) or sig in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(sig)
                often = counted(s, heavy, counts)
                at, m = prefix_places(s, often, percent)
                tokens.append(s[at])
                salts.append(np.where(often[at] >= hot, 1 + sig % salts_of, 0).astype(np.int32))
                places.append(np.arange(len(at), dtype=np.int32))
                lengths.append(len(at))
                sigs.append(sig)
                sizes.append(len(s))
                matches.append(m)
                rare.append(1000 * int((often < OFTEN).sum()) // len(s))
            spread = lambda x, t: pa.array(np.repeat(np.array(x, t), lengths))  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens)), pa.array(np.concatenate(salts)), spread(sigs, np.int64), spread(sizes, np.int32), spread(matches, np.int16), spread(rare, np.int16), pa.array(np.concatenate(places))],
                ["token", "salt", "sig", "n", "l", "rare", "at"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "token long, salt int, sig long, n int, l short, rare short, at int")


def sets_of(docs: DataFrame, text: str, wanted: DataFrame, signs: DataFrame, words: int) -> DataFrame:
    """(sig, tokens) of the wanted sigs and perhaps a few others. signs: (sig, whole) of all
    documents. Bounded sketches of the wanted sigs, and of the hashes of texts that have
    them, say which texts to send; only those are cut into words again. tokens: whole
    sets, the low 48 bits of each."""
    sigs = key_sketch(wanted, "sig")

    def chosen(batches: Batches) -> Batches:
        bits = np.frombuffer(sigs, np.uint32)
        for batch in batches:
            yield batch.filter(pa.array(in_sketch(bits, batch.column("sig").to_numpy())))

    texts = key_sketch(signs.select("sig", "whole").mapInArrow(chosen, "sig long, whole long"), "whole")

    def run(batches: Batches) -> Batches:
        bits, of_texts, seen = np.frombuffer(sigs, np.uint32), np.frombuffer(texts, np.uint32), set()
        for batch in batches:
            found = batch.filter(pa.array(in_sketch(of_texts, batch.column("whole").to_numpy())))
            own = {}
            for _, sets in _sets([found], words):
                own.update((signature(s), s) for s in sets if len(s))
            fresh_ones = [k for k, hit in zip(own, in_sketch(bits, np.array(list(own), np.int64)), strict=True) if hit and k not in seen]
            seen.update(fresh_ones)
            for a in range(0, len(fresh_ones), 500):
                part = fresh_ones[a:a + 500]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([_pack(own[k]) for k in part], pa.binary())], ["sig", "tokens"])

    rows = docs.select(F.col(text).alias("text"), F.xxhash64(text).alias("whole"))
    return rows.mapInArrow(run, "sig long, tokens binary").groupBy("sig").agg(F.first("tokens").alias("tokens"))


def _pack(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<i8").reshape(-1)


def nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()


def verified(pairs: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link. own: (sig, tokens). Sets move to their
    name, and from there each b's once to its a."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keep = []
            x, y = batch.column("x"), batch.column("y")
            for k in range(batch.num_rows):
                p, q = _unpack(x[k].as_py()), _unpack(y[k].as_py())
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    members = pairs.join(own.withColumnsRenamed({"sig": "b", "tokens": "y"}), "b")
    leaders = own.join(pairs.select(F.col("a").alias("sig")).distinct(), "sig", "left_semi").withColumnsRenamed({"sig": "a", "tokens": "x"})
    joined = members.join(leaders, "a")
    return staged(joined.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "links")


def _across(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs of different components, with these in order."""
    for end in ("a", "b"):
        of = nodes.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        pairs = pairs.join(of, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    return pairs.filter("of_a <> of_b").select("a", "b", "part", F.least("of_a", "of_b").alias("c1"), F.greatest("of_a", "of_b").alias("c2"))


def _near(percent: int) -> Callable[[str, str], F.Column]:
    return lambda n, m: F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _least(percent: int) -> F.Column:
    """The least overlap of sets of n1 and n2 tokens that link."""
    return F.ceil((F.col("n1") + F.col("n2")) * percent / (100 + percent) - F.lit(1e-9))


def _alike(percent: int) -> F.Column:
    """Whether no more parities differ than sets that link have tokens apart."""
    apart = sum((F.bit_count(F.col(f"{b}_a").bitwiseXOR(F.col(f"{b}_b"))) for b in BITS), F.lit(0))
    return apart <= F.col("n1") + F.col("n2") - 2 * _least(percent)


def _enough(percent: int) -> F.Column:
    """Whether prefixes share enough tokens. Of the two prefixes one ends first in the
    order; all its tokens that the other set has are in the other prefix. So the overlap is
    at most the shared prefix tokens and what is left of that set, and has to reach the
    least overlap of sets of these sizes. Either prefix may be the one, so the larger rest
    counts. This asks for min(l, m) tokens at least."""
    rest = [F.ceil(F.col(n) * percent / 100 - F.lit(1e-9)) - F.col(m) for n, m in (("n1", "l1"), ("n2", "l2"))]
    return (F.col("shared") >= F.least("l1", "l2")) & (F.col("shared") + F.greatest(*rest) >= _least(percent))


def paired(left: DataFrame, percent: int) -> DataFrame:
    """(a, b, n1, n2, least_shared), a row for each shared token that counts, of pairs in
    different components.
    left: (token, sig, n, l, at, component, BITS). With s the least overlap of sets of n1 and
    n2 tokens, sets that link share at least m tokens of their first n1 - s + m and n2 - s + m,
    as only s - m tokens follow in the one that ends first. m: the smaller l, and BEYOND of
    what both stored prefixes have room for."""
    side = lambda sig, k: left.select("token", F.col("sig").alias(sig), *[F.col(x).alias(f"{y}{k}") for x, y in (("n", "n"), ("l", "l"), ("at", "at"), ("component", "c"))],
                                      *[F.col(x).alias(f"{x}_{sig}") for x in BITS])
    beyond = _least(percent) - F.ceil(F.greatest("n1", "n2") * percent / 100 - F.lit(1e-9))
    least = F.least("l1", "l2") + F.floor(beyond * BEYOND)
    inside = [F.col(f"at{k}") < F.col(f"n{k}") - _least(percent) + least for k in (1, 2)]
    rows = side("a", 1).join(side("b", 2), "token").filter(F.col("a") < F.col("b")).filter(F.col("c1") != F.col("c2"))
    rows = rows.filter(_near(percent)(F.col("n1"), F.col("n2"))).filter(inside[0] & inside[1]).filter(_alike(percent))
    return rows.select("a", "b", "n1", "n2", least.alias("least_shared"))


def similar(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(key, n, component, node, group): set size, the smallest key reachable by links, the
    set's hash and the smallest hash reachable (null for empty sets). One row per document."""
    near, enough = _near(percent), _enough(percent)
    all_rows = staged(signed(docs, text, key, words), "sets-signed")
    top = (all_rows.filter("kind = 1").groupBy("sig").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "sig").limit(HEAVY).toArrow().sort_by("sig"))  # two columns of numbers, no row objects
    heavy, counts = top["sig"].to_numpy(), top["n"].to_numpy()
    signs = all_rows.filter("kind = 0").select("sig", "whole")

    part = Window.partitionBy("token", "salt")
    lists = staged(
        postings(docs, text, heavy, counts, words, percent)
        .select("*", F.lag("sig").over(part.orderBy("sig")).alias("before"), F.min("sig").over(part).alias("low"), F.max("sig").over(part).alias("high"),
                F.min(F.struct("rare", "sig", "n", "l")).over(part).alias("lead"))
        .filter("(salt > 0 or low <> high) and (before is null or before <> sig)").drop("before", "low", "high", "rare"), "lists")
    hot = lists.filter("salt > 0")
    hot = hot.drop("lead").join(hot.groupBy("token").agg(F.min("lead").alias("lead")), "token")
    led = lists.filter("salt = 0").unionByName(hot)

    first = (led.filter(F.col("sig") != F.col("lead.sig")).filter(near(F.col("n"), F.col("lead.n")))
             .groupBy(F.col("lead.sig").alias("a"), F.col("sig").alias("b"), F.col("lead.n").alias("n1"), F.col("n").alias("n2"), F.col("lead.l").alias("l1"), F.col("l").alias("l2"))
             .agg(F.count("*").alias("shared")).filter(enough))
    first = staged(first.select("a", "b"), "candidates")
    links = verified(first, sets_of(docs, text, nodes_of(first), signs, words), percent)

    known = components(links)
    placed = lists.drop("lead", "salt").join(known.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    placed = staged(placed, "placed")
    mixed = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("token")
    odd = all_rows.filter("kind = 0").groupBy("sig").agg(*[F.first(b).alias(b) for b in BITS])
    left = placed.join(mixed, "token").join(odd, "sig")
    second = (paired(left, percent).groupBy("a", "b", "n1", "n2", "least_shared").agg(F.count("*").alias("shared"))
              .filter("shared >= least_shared"))
    second = staged(second.select("a", "b", (F.col("shared") / F.least("n1", "n2")).alias("part")), "candidates")
    own = staged(sets_of(docs, text, nodes_of(second), signs, words), "sets")
    nodes = components(links)
    for most in ROUNDS:
        second = _across(second, nodes)
        place = F.row_number().over(Window.partitionBy("c1", "c2").orderBy(F.desc("part"), "a", "b"))
        tried = second if most is None else second.withColumn("place", place).filter(F.col("place") <= most)
        tried = staged(tried.select("a", "b"), "tried")
        if tried.isEmpty():
            break
        second = second.join(tried, ["a", "b"], "left_anti").select("a", "b", "part")
        links = links.union(verified(tried, own, percent))
        nodes = components(links)
    nodes = nodes.withColumnRenamed("node", "sig")
    own = all_rows.filter("kind = 0").select("key", "n", "sig")
    least = (own.filter("n > 0").groupBy("sig").agg(F.min("key").alias("low"))
             .join(nodes, "sig", "left").withColumn("group", F.coalesce("component", "sig")))
    ids = least.groupBy("group").agg(F.min("low").alias("id"))
    named = staged(least.join(ids, "group").select("sig", "group", "id"), "named")
    return own.join(named, "sig", "left").select(
        "key", "n", F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("id")).alias("component"), F.col("sig").alias("node"), "group")


@tidy
def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The document with the smallest key (then set hash) of each group, with the columns
    it came with; a null key is the largest. Documents without words all stay. Of rows
    equal in key and set, any one stays."""
    found = similar(docs, text, key, words, percent)
    row = fresh(docs, "row_hash")
    keep = (found.filter("n > 0").groupBy("group").agg(F.min(F.struct(F.col("key").isNull(), "key", "node")).alias("m"))
            .select(F.xxhash64("m.key", "m.node").alias(row)))

    def nodes(texts: pd.Series) -> pd.Series:
        return pd.Series([signature(t) if len(t := shingles(x, words)) else None for x in texts], dtype="Int64")

    own = docs.withColumn(row, F.pandas_udf(nodes, "long").asNondeterministic()(F.col(text)))
    some = own.filter(F.col(row).isNotNull()).withColumn(row, F.xxhash64(F.col(key), F.col(row)))
    return (some.join(staged(keep, "kept"), row, "left_semi").dropDuplicates([row])
            .unionByName(own.filter(F.col(row).isNull())).drop(row))
