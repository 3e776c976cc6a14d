"""Line dedup by a deletion-neighbourhood join.

Lines are compared as lists of words; the edit distance counts words inserted, deleted
or replaced, and the bound is one edit for lines of at least NEAR_WORDS words and none
for shorter ones. A line's neighbourhood is itself and every list with one word deleted,
each as a hash and the deleted position (-1 for itself):

* a line that is another one with one word deleted has its own hash in the other's
  neighbourhood;
* two lines that differ in one replaced word have the same variant at the same position.

So equal (hash, position) keys, and hashes equal to a line's own, give every pair within
the bound, and inside such a bucket all lines are within one edit of each other or of
the line the variant spells. Each is therefore joined to the bucket's smallest line
only, never to all. Distances of the joined pairs are verified on the words. Lines that
are linked form classes, of which the earliest occurrence (smallest id, then line
number) stays and all others go.

Two lines within the bound agree in the first or the last half of their words. Only
lines that share such a half with another line can have a partner; halves held twice
set bits in a sketch of fixed size, and the neighbourhoods of the other lines are not
written. This leaves out no pair.

Defined results: blank lines stay as they are and are never compared. Null texts stay
null. Rows equal in id and text are one document to the order of occurrences: they lose
the same lines. A null id comes last. An empty table gives none. Texts and lines of any
length are taken whole. Columns of any name stay as they are: added ones take a name that
is free.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundpanel.llm.common import components, fresh, in_sketch, key_sketch, staged, tidy

NEAR_WORDS = 6
#: Rows of a batch that a task sends on.
SENT = 20_000

Batches = Iterator[pa.RecordBatch]
_ODD = np.uint64(0x9E3779B97F4A7C15)


def lines_of(text: str | None) -> list[tuple[int, list[bytes]]]:
    """Numbers and words (ASCII white space) of the lines that have a word."""
    own = ((k, x.split()) for k, x in enumerate((text or "").encode("utf-8", "surrogatepass").split(b"\n")))
    return [(k, w) for k, w in own if w]


def text_hash(text: str | None) -> int:
    """Spark's xxhash64 of a text; null counts as empty."""
    own = xxhash.xxh64_intdigest((text or "").encode("utf-8", "surrogatepass"), seed=42)
    return own - (1 << 64) if own >> 63 else own


def line_hash(line: bytes) -> int:
    """line: words with one blank between them."""
    return xxhash.xxh3_64_intdigest(line) - (1 << 63)


def half_keys(words: list[bytes], line: bytes) -> list[int]:
    """Hashes of the halves of which a line within one edit has at least one. With the
    shorter of two lines n words long, they agree in the first n // 2 words or in the last
    (n - 1) // 2; a line of n words may be the shorter or the longer one."""
    n = len(words)
    first = (n - 1) // 2
    to = len(b" ".join(words[:first]))
    out = [xxhash.xxh3_64_intdigest(line[:to], seed=1) - (1 << 63)]
    if n % 2 == 0:
        out.append(xxhash.xxh3_64_intdigest(line[:to + 1 + len(words[first])], seed=1) - (1 << 63))
    least = (n - 2) // 2
    start = len(line) - len(b" ".join(words[n - least:]))
    out.append(xxhash.xxh3_64_intdigest(line[start:], seed=2) - (1 << 63))
    if n % 2:
        out.append(xxhash.xxh3_64_intdigest(line[start - 1 - len(words[n - least - 1]):], seed=2) - (1 << 63))
    return out


def variants(words: list[bytes]) -> np.ndarray:
    """Hashes of the line and of the line without word 0, 1, ..: sums of word hashes
    weighted by place, of the words before and, one place moved, after the deleted one."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    place = np.cumprod(np.full(len(words), _ODD))
    before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * place)])
    moved = np.cumsum((h[1:] * place[:-1])[::-1])[::-1]
    after = np.concatenate([moved, np.zeros(1, np.uint64)])
    return np.concatenate([before[-1:], before[:-1] + after]).view(np.int64)


def within_one_edit(a: list[bytes], b: list[bytes]) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def occurrences(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(key, doc, line, h, near, halves): a row for each line with a word; doc is a hash
    of the text, near whether the line is long enough for an edit."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, doc long, line int, h long, halves array<long>"

    def run(batches: Batches) -> Batches:
        for batch in batches:
            at, docs_of, places, hashes, counts, halves = [], [], [], [], [], []
            for i, t in enumerate(batch.column("text")):
                t = t.as_py()
                doc = text_hash(t)
                for k, words in lines_of(t):
                    line = b" ".join(words)
                    own = half_keys(words, line) if len(words) >= NEAR_WORDS else ()
                    at.append(i)
                    docs_of.append(doc)
                    places.append(k)
                    hashes.append(line_hash(line))
                    counts.append(len(own))
                    halves.extend(own)
                    if len(at) == SENT:
                        yield sent(batch, at, docs_of, places, hashes, counts, halves)
                        at, docs_of, places, hashes, counts, halves = [], [], [], [], [], []
            yield sent(batch, at, docs_of, places, hashes, counts, halves)

    def sent(batch: pa.RecordBatch, at, docs_of, places, hashes, counts, halves) -> pa.RecordBatch:
        ends = pa.array(np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int32))
        lists = pa.ListArray.from_arrays(ends, pa.array(np.array(halves, np.int64)))
        return pa.RecordBatch.from_arrays(
            [batch.column("key").take(pa.array(at, pa.int64())), pa.array(np.array(docs_of, np.int64)), pa.array(np.array(places, np.int32)), pa.array(np.array(hashes, np.int64)), lists],
            ["key", "doc", "line", "h", "halves"])

    return rows.mapInArrow(run, schema)


def neighbourhoods(docs: DataFrame, text: str, sketch: bytes) -> DataFrame:
    """(h, variant, place, words): neighbourhoods of the lines that share a half; words only
    in the row of the line itself. A line that a task has written is not written again."""
    def run(batches: Batches) -> Batches:
        mask, seen = 8 * len(sketch) - 1, set()
        for batch in batches:
            h, v, w = [], [], []
            rows = 0
            for t in batch.column("text"):
                for _, words in lines_of(t.as_py()):
                    if len(words) < NEAR_WORDS:
                        continue
                    line = b" ".join(words)
                    own = line_hash(line)
                    # the sketch's bits are in little-endian words, so also in its bytes
                    if own in seen or not any(sketch[(k & mask) >> 3] >> (k & 7) & 1 for k in half_keys(words, line)):
                        continue
                    if len(seen) < 1_000_000:
                        seen.add(own)
                    h.append(own)
                    v.append(variants(words))
                    w.append(line)
                    rows += len(words) + 1
                    if rows >= SENT:
                        yield sent(h, v, w)
                        h, v, w, rows = [], [], [], 0
            yield sent(h, v, w)

    def sent(h: list[int], v: list[np.ndarray], w: list[bytes]) -> pa.RecordBatch:
        lengths = [len(x) for x in v]
        place = np.concatenate([np.zeros(0, np.int32), *[np.arange(-1, n - 1, dtype=np.int32) for n in lengths]])
        first = np.cumsum([0, *lengths])[:-1].astype(np.int64)
        of, away = np.zeros(len(place), np.int64), np.ones(len(place), bool)
        of[first], away[first] = np.arange(len(w)), False
        words = pa.array(w, pa.binary()).take(pa.array(of, mask=away))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(h, np.int64), lengths)), pa.array(np.concatenate([np.zeros(0, np.int64), *v])), pa.array(place), words],
            ["h", "variant", "place", "words"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "h long, variant long, place int, words binary")


def near_links(docs: DataFrame, text: str, occurring: DataFrame) -> DataFrame:
    """(a, b): hashes of lines within one edit of each other, enough of them to connect
    every two lines that are within the bound."""
    several = F.min("h") != F.max("h")
    halves = occurring.select("h", F.explode("halves").alias("half")).groupBy("half").agg(several.alias("several")).filter("several")
    found = staged(neighbourhoods(docs, text, key_sketch(halves, "half")), "neighbourhoods")
    # most variants are met by one line only; their rows are not moved again
    met = key_sketch(found.groupBy("variant").agg(several.alias("several")).filter("several"), "variant")

    def some(batches: Batches) -> Batches:
        bits = np.frombuffer(met, np.uint32)
        for batch in batches:
            yield batch.filter(pa.array(in_sketch(bits, batch.column("variant").to_numpy())))

    keys = staged(found.select("h", "variant", "place").mapInArrow(some, "h long, variant long, place int").distinct(), "variants")
    deleted = keys.filter("place >= 0")
    whole = keys.filter("place = -1").select(F.col("h").alias("b"), "variant")
    shorter = deleted.join(whole, "variant").select(F.col("h").alias("a"), "b")
    leads = deleted.groupBy("variant", "place").agg(F.min("h").alias("b"), F.count("*").alias("n")).filter("n > 1").drop("n")
    replaced = deleted.join(leads, ["variant", "place"]).select(F.col("h").alias("a"), "b")
    pairs = shorter.union(replaced).filter("a <> b").distinct()
    pairs = staged(pairs, "pairs")
    words = (found.filter("place = -1").select("h", "words")
             .join(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), "h", "left_semi").groupBy("h").agg(F.first("words").alias("words")))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keep = [within_one_edit(x.as_py().split(), y.as_py().split()) for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = (pairs.join(words.select(F.col("h").alias("a"), F.col("words").alias("x")), "a")
            .join(words.select(F.col("h").alias("b"), F.col("words").alias("y")), "b"))
    return staged(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "links")


def repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, doc, line): every line that a class of equal or near lines has earlier."""
    occurring = staged(occurrences(docs, text, key), "occurrences")
    classes = components(near_links(docs, text, occurring))
    order = F.struct(F.col("key").isNull().alias("last"), "key", "doc", "line")
    own = occurring.groupBy("h").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    own = own.join(classes, own.h == classes.node, "left").withColumn("class", F.coalesce("component", "h"))
    first = own.groupBy("class").agg(F.min("first").alias("first"), F.sum("n").alias("n")).filter("n > 1")
    repeated = staged(own.select("h", "class").join(first, "class").select("h", "first"), "classes")
    later = occurring.select("key", "doc", "line", "h").join(repeated, "h")
    return later.filter(~F.col("key").eqNullSafe(F.col("first.key"))
                        | (F.col("doc") != F.col("first.doc")) | (F.col("line") != F.col("first.line"))).select("key", "doc", "line")


@tidy
def without_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All documents with the columns they came with, their texts without the lines that
    stand earlier. A text whose lines all go is empty."""
    gone = repeated_lines(docs, text, key).groupBy("key", "doc").agg(F.collect_set("line").alias("gone"))
    row, lost = fresh(docs, "row_hash"), fresh(docs, "lost_lines")
    gone = staged(gone.select(F.xxhash64("key", "doc").alias(row), F.col("gone").alias(lost)), "gone")
    sketch = key_sketch(gone, row)

    def touched(rows: pd.Series) -> pd.Series:
        return pd.Series(in_sketch(np.frombuffer(sketch, np.uint32), rows.to_numpy(np.int64)))

    # only texts that lose a line are moved to their list of lines
    own = docs.withColumn(row, F.xxhash64(F.col(key), F.xxhash64(F.coalesce(F.col(text), F.lit("")))))
    hit = F.pandas_udf(touched, "boolean")(F.col(row))
    # the list of lines is a column of its own: inside the transform the text would be split for every line
    parts, left = fresh(docs, "text_lines"), F.col(lost).isNull() | F.col(text).isNull()
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(lost))
    rest = F.array_join(F.transform(kept, lambda k: F.get(F.col(parts), k)), "\n")
    joined = (own.filter(hit).join(gone, row, "left").withColumn(parts, F.split(F.col(text), "\n"))
              .withColumn(text, F.when(left, F.col(text)).otherwise(rest)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return own.filter(~hit).select(*columns).union(joined.select(*columns))
