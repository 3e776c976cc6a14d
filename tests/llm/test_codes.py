"""Vector codes against a plain search of every entry, and the GNAT by itself."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from fundpanel.llm import codes


def plain(rows, parts=16, entries=64, rounds=2):
    """rows: (id, vector, label) -> ({id: (code, error)}, digest) in plain whole numbers."""
    kept = [(i, [math.floor(256 * x) for x in v], g) for i, v, g in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[cut[e][p] for e in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            of = [nearest(c[p], book)[1] for c in cut]
            for e in range(len(book)):
                own = [c[p] for c, k in zip(cut, of, strict=True) if k == e]
                if own:
                    book[e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    out = []
    for (i, _, g), c in zip(kept, cut, strict=True):
        found = [nearest(x, book) for x, book in zip(c, books, strict=True)]
        out.append((i, g, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    text = ",".join(str(x) for book in books for e in book for x in e)
    return [(i, g, c, d, sum(r[3] for r in out if r[1] == g)) for i, g, c, d in out], hashlib.sha256(text.encode()).hexdigest()


def found(df, **options):
    rows, books = codes.compress(df, **options)
    return sorted((tuple(r) for r in rows.select("id", "label", "code", "error", "label_error").collect()), key=repr), codes.digest(books)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    near = [[float(x) for x in np.round(rng.normal(0, 0.02, 32) * 128) / 256] for _ in range(150)]  # many ties
    rows = [(i, v, int(i % 3) if i % 7 else None) for i, v in enumerate(near)]
    odd = [(900, None, 1), (901, [], 1), (902, [None] * 32, 1), (903, [float("nan")] * 32, 2), (904, [*near[0][:31], float("inf")], None), (905, [*near[0][:31], -float("inf")], None),
           (906, [0.0] * 32, 1), (None, near[5], 2), (None, near[6], 2), (3, near[9], 0), (3, near[9], 0), (907, near[2], 1)]
    return rows + odd


def test_codes_are_those_of_a_plain_search(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, i) for i, r in enumerate(rows)], "vec_id long, embedding array<double>, label int, code string, part int, entry int").repartition(3)
    want, digest = plain(rows)
    got = found(df)
    assert got == (sorted(want, key=repr), digest)


def test_fewer_vectors_than_entries_and_other_shapes(spark, rows):
    few = rows[:9]
    got = found(spark.createDataFrame(few, "vec_id long, embedding array<float>, label int"), parts=4, entries=12, rounds=3)
    want, digest = plain(few, 4, 12, 3)
    assert got == (sorted(want, key=repr), digest)


def test_components_beyond_64_bits(spark):
    rows = [(i, [10.0**e * s for e, s in zip((0, 3, 12, 20), (i, 1, -i, i * i), strict=True)], 0) for i in range(1, 12)]
    want, digest = plain(rows, 2, 4)
    got = found(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), parts=2, entries=4)
    fits = [(i, g, c, d if d < 1 << 63 else None) for i, g, c, d, _ in want]
    assert [r[:4] for r in got[0]] == sorted(fits, key=repr) and got[1] == digest


def test_other_lengths_and_empty_tables(spark, rows):
    df = spark.createDataFrame([*rows, (5000, [1.0, 2.0], 1)], "vec_id long, embedding array<double>, label int")
    assert [r for r in found(df)[0] if r[0] == 5000][0][2:4] == (None, None)
    uneven = spark.createDataFrame([(1, [1.0] * 5, 1)], "vec_id long, embedding array<double>, label int")
    assert found(uneven) == ([(1, 1, None, None, None)], hashlib.sha256(b"").hexdigest())
    assert found(df.limit(0))[0] == []
    assert found(df.filter("embedding is null"))[0] == []


@pytest.mark.parametrize("width, spread", [(1, 4), (2, 6), (8, 40), (8, 3), (4, 10**8)])
def test_tree_finds_the_nearest_with_ties_to_the_lower_index(width, spread):
    rng = np.random.default_rng(width * spread % 1000)
    for count in (1, 8, 9, 64, 300):
        entries = rng.integers(-spread, spread + 1, (count, width))
        parts = rng.integers(-2 * spread, 2 * spread + 1, (400, width))
        apart = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
        index, best = codes.Gnat(entries).nearest(parts)
        assert (index == apart.argmin(axis=1)).all() and (best == apart.min(axis=1)).all()


def test_tree_leaves_out_subtrees():
    rng = np.random.default_rng(6)
    centres = rng.integers(-10_000, 10_000, (16, 8))
    entries = (centres[:, None] + rng.integers(-50, 50, (16, 40, 8))).reshape(-1, 8)
    tree = codes.Gnat(entries)
    tree.nearest(entries + rng.integers(-20, 20, entries.shape))
    assert tree.measured < 0.25 * len(entries) ** 2


def test_roots_are_rounded_to_the_safe_side():
    x = np.array([0, 1, 2, 3, 4, 10**18, 10**18 - 1, (1 << 30) ** 2 - 1, (1 << 60) + 1])
    for values in (x, x.astype(object)):
        down, up = codes._root(values, up=False), codes._root(values, up=True)
        assert [int(d) for d in down] == [math.isqrt(int(v)) for v in x]
        assert all(int(u) == math.isqrt(int(v)) + (math.isqrt(int(v)) ** 2 < v) for u, v in zip(up, x, strict=True))
