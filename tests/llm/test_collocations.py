"""Phrase collocations against a plain count of all windows."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest

from fundpanel.llm import collocations

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, longest, top, absorbed=100):
    """rows: (text, lang). One list of result rows."""
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(FOLD)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                for at in range(len(words) - size + 1):
                    f[lang or "und", tuple(words[at:at + size])] += 1
    f = {k: c for k, c in f.items() if c >= least}
    out = collections.defaultdict(list)
    for (lang, w), a in f.items():
        if len(w) == 1:
            continue
        if any(len(v) > len(w) and 100 * c >= absorbed * a and any(v[i:i + len(w)] == w for i in range(len(v))) for (g, v), c in f.items() if g == lang):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((g, i, p.decode(), -a, left, right, n[g], -s) for g, own in out.items() for i, (s, a, p, left, right) in enumerate(sorted(own)[:top], 1))


def found(df, **options):
    return sorted(tuple(r) for r in collocations.collocations(df, **options).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["the", "The", "of", "a", "big", "é", "data", "set", "is", "中", "a\x1cb", "x" * 300, "w7", "w8", "w9", "."]
    weights = [20, 5, 15, 12, 6, 4, 8, 8, 9, 2, 2, 1, 1, 1, 1, 12]
    texts = [" ".join(rng.choices(words, weights, k=rng.randrange(60))) for _ in range(60)]
    odd = [None, "", " \t ", "...", "a,a;a:a!a?a\na\x0ba\x0ca\ra", "a a a a a a a", "the big data set is the big data set", "big\tdata  set", "BIG DATA SET is É"]
    rows = [(t, rng.choice(["en", "fr", None, "und"])) for t in [*texts, *odd, *odd]]
    return rows + rows[:5]


@pytest.mark.parametrize("ranked, longest", [(1 << 20, 5), (4, 5), (1, 3)])
def test_every_window_is_counted(spark, rows, ranked, longest):
    """With few numbers most windows hold a word or a phrase beyond the ranked ones."""
    df = spark.createDataFrame([(t, g, i, "x", 1) for i, (t, g) in enumerate(rows)], "text string, lang string, phrase int, f string, size int").repartition(3)
    assert found(df, least=4, longest=longest, ranked=ranked) == plain(rows, 4, longest, 2000)


def test_top_and_absorbed(spark, rows):
    df = spark.createDataFrame(rows, "text string, lang string")
    assert found(df, least=3, top=7, absorbed=80) == plain(rows, 3, 5, 7, 80)


def test_dense_tiles_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    a, b = rng.zipf(1.3, (2, 40_000)) % 2000
    monkeypatch.setattr(collocations, "MOST_TILES", 2)
    monkeypatch.setattr(collocations, "TILE", 64)
    tiles = collocations.Tiles(2000)
    for at in range(0, len(a), 10_000):
        tiles.add(a[at:at + 10_000].astype(np.int64), b[at:at + 10_000].astype(np.int64))
    tiles.add(a[:0], b[:0])
    assert 0 < len(tiles.dense) <= 2
    got = collections.Counter()
    for keys, counts in [tiles.loose_counts(), *tiles.dense_counts()]:
        got.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
    assert got == collections.Counter((a.astype(np.int64) << 32 | b).tolist())

    monkeypatch.setattr(collocations, "BLOCK", 10)
    ids = [3, 4, -1, -1, 5, -2, 6, 7, 8, 9, 1, 1, -2, 2, -1, 4, 4, -1]
    blocks = list(collocations._blocks("en", ids, [b"p", b"q"]))
    whole = np.concatenate([np.frombuffer(x.column("ids")[0].as_py(), "<i4") for x in blocks])
    assert whole.tolist() == [3, 4, -1, 5, -2, 6, 7, 8, 9, 1, 1, -2, 2, -1, 4, 4, -1]
    assert [x.column("others")[0].as_py() for x in blocks] == [[b"p", b"q"], []]


def test_very_long_text_and_large_products(spark):
    text = "a b " * 150_000
    got = found(spark.createDataFrame([(text, "en")], "text string, lang string"))
    assert got == plain([(text, "en")], 100, 5, 2000)
    from pyspark.sql import functions as F

    big = 3 * 10**13
    row = spark.range(1).select(collocations._score(F.lit(big), F.lit(big + 7), F.lit(big + 1), F.lit(big - 1)).alias("s")).first()
    assert row["s"] == 1000 * big * (big + 7) // ((big + 1) * (big - 1))


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "text string, lang string")) == []
    assert found(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")) == []
