"""Phrase collocation mining by direct-address tiling.

Words get numbers by frequency, the most frequent first, so that the counts of neighbouring
words are the cells of a square matrix whose full corner lies at low numbers. The matrix is
cut into tiles of TILE x TILE cells. In a task, tiles that get many pairs are counted by
address, one dense numpy array each and `bincount` over the cells; pairs of all other tiles
are collected as coordinates, sorted, and counted by run length. Pairs that the whole
corpus has often enough are then numbered by frequency themselves, and the same is done
again: a phrase of k words is a pair of two phrases of k - 1 words, one word apart, both of
which have to be frequent.

A text is read once for word counts and once for the number streams, which are kept in the
shared folder: numbers of the frequent words of a language in order, with a gap where a
piece ends or a word is not frequent. Later passes read streams only. Tasks send counts of
distinct cells, and Spark sums them.

What every task gets is bounded: the numbers of the RANKED most frequent words and phrases
of each length. Frequent words and phrases beyond that are whole too: where a window holds
one, it is counted by its words as text, in a plain grouped count. Which texts of these are
worth counting is told by a bit set of bounded size over the frequent ones; as it fills up,
more windows are counted and dropped by their count.

Numbers of phrases and scores: see `collocations`. All counts are of all documents.

Defined results: A to Z are lower-cased, pieces end at `.,;:!?` and line ends (bytes 10 to
13), words are cut at blanks and tabs. Null, empty and blank texts have no words. A null
language is `und`, together with documents that say so. Texts of any length are taken
whole; streams are cut into blocks between pieces only. Repeated rows count again. Ties go by count, then phrase in byte order. An empty
table gives an empty table. Only the two named columns are read, so others may have any
name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundpanel.llm.common import in_sketch, key_sketch, staged

LEAST, LONGEST, TOP, SCALE = 100, 5, 2000, 1000
#: Percent of a phrase's count from which a longer phrase stands for it.
ABSORBED = 100
RANKED, TILE, MOST_TILES, SKETCH = 1 << 20, 512, 16, 23
#: Different words or phrases, and cells, that a task holds before it sends them, and words
#: of a stream block.
HELD, CELLS, BLOCK = 1 << 17, 1 << 20, 1 << 18
GAP, UNNUMBERED = -1, -2
#: Marks the end of a piece; not a byte of UTF-8.
END = b"\xff"
_FOLD = bytes(END[0] if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
Batches = Iterator[pa.RecordBatch]


def words_of(text: bytes) -> list[bytes]:
    """Words of a whole text in order, with END after each piece."""
    return text.translate(_FOLD).replace(END, b" " + END + b" ").split()


def hash_of(lang: str, phrase: bytes) -> int:
    """Spark's xxhash64 of "<lang> <phrase>"."""
    return int(np.uint64(xxhash.xxh64_intdigest(lang.encode() + b" " + phrase, seed=42)).astype(np.int64))


@dataclass
class Level:
    """Numbered phrases of one length: `keys` sorted, `rank` of each. words: their word
    numbers by rank. bits: bit set over the frequent phrases that have no number."""

    words: np.ndarray
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rank: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    bits: bytes | None = None

    def has(self, lang: str, phrase: bytes) -> bool:
        return self.bits is not None and bool(in_sketch(np.frombuffer(self.bits, np.uint32), np.array([hash_of(lang, phrase)]))[0])


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text")).filter("text is not null")


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, f) of all words."""

    def run(batches: Batches) -> Batches:
        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                held.setdefault(lang, Counter()).update(words_of(text.as_py()))
                if sum(map(len, held.values())) > HELD:
                    yield from _counts(held)
                    held = {}
        yield from _counts(held)

    rows = texts.mapInArrow(run, "lang string, word string, f long")
    return rows.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _counts(held: dict[str, Counter]) -> Batches:
    for lang, counts in held.items():
        counts.pop(END, None)
        words = list(counts)
        for at in range(0, len(words), 100_000):
            part = words[at:at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang), len(part)), pa.array(part, pa.binary()).cast(pa.string()), pa.array([counts[w] for w in part], pa.int64())], ["lang", "word", "f"])


def _ranked(frequent: DataFrame, columns: list[str], most: int) -> list[tuple]:
    """The most frequent rows, by falling count; `most` of them at most."""
    return [tuple(r) for r in frequent.orderBy(F.desc("f"), *columns).limit(most).select(*columns).toPandas().itertuples(index=False)]


def _rest(frequent: DataFrame, count: int, ranked: int) -> bytes | None:
    """Bit set over all frequent phrases of a length, where some have no number."""
    return key_sketch(frequent.select(F.xxhash64(F.concat_ws(" ", "lang", "phrase")).alias("h")), "h", SKETCH) if count > ranked else None


def streams(texts: DataFrame, words: list[tuple[str, str]], level: Level) -> DataFrame:
    """(lang, ids, others): little-endian 32-bit numbers of the words of a language in
    order, GAP between pieces and for words that are not frequent, UNNUMBERED for frequent
    words beyond the ranked ones, which are in `others` in order."""
    numbers: dict[str, dict[bytes, int]] = {}
    for k, (lang, word) in enumerate(words):
        numbers.setdefault(lang, {})[word.encode()] = k
    shared = texts.sparkSession.sparkContext.broadcast((numbers, level))

    def run(batches: Batches) -> Batches:
        numbers, level = shared.value
        held: dict[str, tuple[list[int], list[bytes]]] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                own = words_of(text.as_py())
                ids = list(map(numbers.get(lang, {}).get, own))
                others: list[bytes] = []
                if level.bits is not None:
                    known: dict[bytes, bool] = {}
                    for k, (i, w) in enumerate(zip(ids, own, strict=True)):
                        if i is None and w != END:
                            if w not in known:
                                known[w] = level.has(lang, w)
                            if known[w]:
                                ids[k] = UNNUMBERED
                                others.append(w)
                row = held.setdefault(lang, ([], []))
                row[0].extend(GAP if i is None else i for i in ids)
                row[0].append(GAP)
                row[1].extend(others)
                if len(row[0]) > BLOCK:
                    yield from _blocks(lang, *held.pop(lang))
        for lang, row in held.items():
            yield from _blocks(lang, *row)

    return staged(texts.mapInArrow(run, "lang string, ids binary, others array<binary>"), "streams")


def _blocks(lang: str, ids: list[int], others: list[bytes]) -> Batches:
    """Blocks of a stream, without runs of gaps and cut at gaps."""
    x = np.array(ids, np.int32)
    x = x[(x != GAP) | np.append(True, x[:-1] != GAP)]
    others_before = np.append(0, np.cumsum(x == UNNUMBERED))
    at = 0
    while at < len(x):
        to = at + BLOCK
        if to < len(x):
            gaps = np.flatnonzero(x[to:] == GAP)
            to = to + int(gaps[0]) + 1 if len(gaps) else len(x)
        own = x[at:to]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([own.astype("<i4").tobytes()], pa.binary()),
             pa.array([others[others_before[at]:others_before[min(to, len(x))]]], pa.list_(pa.binary()))], ["lang", "ids", "others"])
        at = to


class Tiles:
    """Counts of pairs of numbers, held by one task."""

    def __init__(self, size: int) -> None:
        self.side = -(-max(size, 1) // TILE)
        self.dense: dict[int, np.ndarray] = {}
        self.loose: list[np.ndarray] = []
        self.held = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if not len(a):
            return
        tile = (a // TILE) * self.side + b // TILE
        order = np.argsort(tile, kind="stable")
        a, b, tile = a[order], b[order], tile[order]
        starts = np.flatnonzero(np.diff(tile, prepend=-1))
        for at, to in zip(starts, np.append(starts[1:], len(tile)), strict=True):
            t = int(tile[at])
            full = to - at >= TILE * TILE // 16
            if t in self.dense or full and len(self.dense) < MOST_TILES:
                cells = (a[at:to] % TILE) * TILE + b[at:to] % TILE
                self.dense[t] = self.dense.get(t, 0) + np.bincount(cells, minlength=TILE * TILE)
            else:
                self.loose.append(a[at:to] << 32 | b[at:to])
                self.held += to - at

    def loose_counts(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([np.zeros(0, np.int64), *self.loose])
        self.loose, self.held = [], 0
        return np.unique(keys, return_counts=True)

    def dense_counts(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for t, counts in self.dense.items():
            cells = np.flatnonzero(counts)
            a, b = t // self.side * TILE + cells // TILE, t % self.side * TILE + cells % TILE
            yield a << 32 | b, counts[cells]


def _paired(state: np.ndarray, level: Level, phrase, lang: str) -> np.ndarray:
    """Numbers of the phrases one word longer at each place: GAP where they are not
    frequent, UNNUMBERED where they may be but have no number."""
    a, b = state[:-1], state[1:]
    out = np.full(len(a), GAP, np.int64)
    own = np.flatnonzero((a >= 0) & (b >= 0))
    if len(own) and len(level.keys):
        key = a[own] << 32 | b[own]
        at = np.minimum(np.searchsorted(level.keys, key), len(level.keys) - 1)
        hit = level.keys[at] == key
        out[own[hit]] = level.rank[at[hit]]
    if level.bits is not None:
        for p in np.flatnonzero((out == GAP) & (a != GAP) & (b != GAP)):
            if level.has(lang, phrase(p)):
                out[p] = UNNUMBERED
    return out


def phrase_counts(rows: DataFrame, words: list[tuple[str, str]], levels: list[Level]) -> DataFrame:
    """(lang, phrase, key, f) of the phrases one word longer than those of the last level
    that may be frequent. key: the two numbers of their parts, null where a part has none;
    lang and phrase only then."""
    shared = rows.sparkSession.sparkContext.broadcast((words, levels))
    length = len(levels) + 1

    def run(batches: Batches) -> Batches:
        words, levels = shared.value
        texts = [w.encode() for _, w in words]
        tiles, plain = Tiles(len(levels[-1].words)), Counter()
        for batch in batches:
            for lang, ids, others in zip(batch.column("lang").to_pylist(), batch.column("ids"), batch.column("others"), strict=True):
                x = np.frombuffer(ids.as_buffer(), "<i4").astype(np.int64)
                names = others.as_py()
                place = np.cumsum(x == UNNUMBERED) - 1

                def phrase(p: int, n: int) -> bytes:
                    return b" ".join([texts[x[q]] if x[q] >= 0 else names[place[q]] for q in range(p, p + n)])  # noqa: B023

                state = x
                for n, level in enumerate(levels[1:], 2):
                    state = _paired(state, level, lambda p: phrase(p, n), lang)  # noqa: B023
                a, b = state[:-1], state[1:]
                own = (a >= 0) & (b >= 0)
                tiles.add(a[own], b[own])
                for p in np.flatnonzero(~own & (a != GAP) & (b != GAP)):
                    plain[lang, phrase(p, length)] += 1
                if tiles.held > CELLS:
                    yield from _cells(*tiles.loose_counts())
                if len(plain) > HELD:
                    yield from _plain(plain)
                    plain = Counter()
        yield from _cells(*tiles.loose_counts())
        for keys, counts in tiles.dense_counts():
            yield from _cells(keys, counts)
        yield from _plain(plain)

    sent = rows.mapInArrow(run, "lang string, phrase string, key long, f long")
    return sent.groupBy("lang", "phrase", "key").agg(F.sum("f").alias("f"))


def _cells(keys: np.ndarray, counts: np.ndarray) -> Batches:
    for at in range(0, len(keys), 100_000):
        part = keys[at:at + 100_000]
        none = pa.nulls(len(part), pa.string())
        yield pa.RecordBatch.from_arrays([none, none, pa.array(part), pa.array(counts[at:at + 100_000].astype(np.int64))], ["lang", "phrase", "key", "f"])


def _plain(counts: Counter) -> Batches:
    rows = list(counts.items())
    for at in range(0, len(rows), 100_000):
        part = rows[at:at + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k, _ in part], pa.string()), pa.array([k[1] for k, _ in part], pa.binary()).cast(pa.string()),
             pa.nulls(len(part), pa.int64()), pa.array([c for _, c in part], pa.int64())], ["lang", "phrase", "key", "f"])


def _spelled(frequent: DataFrame, words: list[tuple[str, str]], last: Level) -> DataFrame:
    """(lang, phrase, key, f) with the words of every key."""
    shared = frequent.sparkSession.sparkContext.broadcast((words, last.words))

    def run(batches: Batches) -> Batches:
        words, numbers = shared.value
        for batch in batches:
            lang, phrase = batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()
            for k, key in enumerate(batch.column("key").to_pylist()):
                if key is not None:
                    own = [*numbers[key >> 32], numbers[key & 0xFFFFFFFF][-1]]
                    lang[k], phrase[k] = words[own[0]][0], " ".join(words[i][1] for i in own)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(phrase, pa.string()), batch.column("key"), batch.column("f")], ["lang", "phrase", "key", "f"])

    return frequent.mapInArrow(run, "lang string, phrase string, key long, f long")


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
                     ranked: int = RANKED) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, f) of all phrases of up to `longest` words that occur `least`
    times or more, (lang, n) of all word occurrences)."""
    texts = _texts(docs, text, lang)
    counts = staged(word_counts(texts), "words")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = counts.filter(F.col("f") >= least).select("lang", F.col("word").alias("phrase"), "f")
    found = frequent.withColumn("size", F.lit(1))
    words = _ranked(frequent, ["lang", "phrase"], ranked)
    levels = [Level(np.arange(len(words))[:, None], bits=_rest(frequent, frequent.count(), len(words)))]
    rows = streams(texts, words, levels[0])
    for size in range(2, longest + 1):
        last = levels[-1]
        if not len(last.words) and last.bits is None:
            break
        counted = phrase_counts(rows, words, levels).filter(F.col("f") >= least)
        frequent = staged(_spelled(counted, words, last), "phrases")
        found = found.unionByName(frequent.select("lang", "phrase", "f", F.lit(size).alias("size")))
        keys = np.array([k for k, in _ranked(frequent.filter("key is not null"), ["key"], ranked)], np.int64)
        own = np.concatenate([last.words[keys >> 32], last.words[keys & 0xFFFFFFFF][:, -1:]], axis=1)
        order = np.argsort(keys)
        levels.append(Level(own, keys[order], order, _rest(frequent, frequent.count(), len(keys))))
    return found, totals


def _score(a: Column, n: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(SCALE * a * n / (l * r)) in decimals of 38 digits, which hold the products."""
    whole = [c.cast("decimal(19,0)") for c in (a, n, l, r)]
    scaled = (F.lit(SCALE).cast("decimal(4,0)") * (whole[0] * whole[1]).cast("decimal(34,0)"))
    return F.call_function("div", scaled, whole[2] * whole[3])


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
                 top: int = TOP, ranked: int = RANKED, absorbed: int = ABSORBED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of 2 to
    `longest` words. a: occurrences; l and r: those of the two parts at the cut with the
    lowest score floor(SCALE * a * n / (l * r)), the first of such cuts; n: the language's
    word occurrences. Phrases that lie within a longer one with at least `absorbed` percent
    of their count are left out."""
    found, totals = frequent_phrases(docs, text, lang, least, longest, ranked)
    found = staged(found, "frequent")
    own = found.filter("size > 1").withColumn("w", F.split("phrase", " "))

    def joined(at: Column | int, size: Column | int) -> Column:
        return F.array_join(F.slice("w", at, size), " ")

    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = own.select("lang", "phrase", "size", "w", F.col("f").alias("a"), cut).select(
        "lang", "phrase", "a", "k", joined(1, F.col("k")).alias("first"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("second"))
    for part, name in (("first", "l"), ("second", "r")):
        cuts = cuts.join(found.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", part])
    scored = cuts.join(totals, "lang").withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))

    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda s: F.transform(
        F.sequence(F.lit(1), F.col("size") - s + 1), lambda at: joined(at, s))))).alias("phrase")
    longer = own.filter("size > 2").select("lang", "f", "w", "size").select("lang", "f", inner).groupBy("lang", "phrase").agg(F.max("f").alias("above"))
    kept = best.join(longer, ["lang", "phrase"], "left").filter(f"above is null or 100 * above < {absorbed} * a")
    rows = kept.select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same in DuckDB's SQL: all windows are counted.
ORACLE = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
windows AS (
  SELECT lang, size, list_aggregate(w[p + 1:p + size], 'string_agg', ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(len(w) - size + 1)) AS p FROM words, range(1, {LONGEST + 1}) AS s(size) WHERE len(w) >= size)),
total AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM words GROUP BY lang),
found AS (SELECT lang, size, phrase, CAST(count(*) AS HUGEINT) AS f FROM windows GROUP BY ALL HAVING count(*) >= {LEAST}),
own AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM found WHERE size > 1),
cuts AS (SELECT o.*, unnest(range(1, size)) AS k FROM own AS o),
scored AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.k, x.f AS l, y.f AS r, n, ({SCALE} * c.a * n) // (x.f * y.f) AS score
  FROM cuts AS c
  JOIN found AS x ON x.lang = c.lang AND x.phrase = list_aggregate(c.w[1:c.k], 'string_agg', ' ')
  JOIN found AS y ON y.lang = c.lang AND y.phrase = list_aggregate(c.w[c.k + 1:], 'string_agg', ' ')
  JOIN total AS t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, list_aggregate(w[p + 1:p + s], 'string_agg', ' ') AS phrase, max(a) AS above
  FROM (SELECT lang, w, a, s, unnest(range(size - s + 1)) AS p FROM own, range(2, {LONGEST}) AS r(s) WHERE s < size) GROUP BY ALL),
kept AS (SELECT b.* FROM best AS b LEFT JOIN longer USING (lang, phrase) WHERE above IS NULL OR 100 * above < {ABSORBED} * a)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= {TOP}
"""
