"""MinHash near-duplicates against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundpanel.llm import near_dups
from fundpanel.llm.ngram_join import shingles


def plain(rows, percent=85, words=5):
    """rows: (id, text) -> sorted (id, n, smallest id reachable)."""
    sets = [{tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
            for w in ((t or "").encode().lower().split() for _, t in rows)]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[top(i)] = top(j)
    members = {}
    for i, (key, _) in enumerate(rows):
        members.setdefault(top(i), []).append(key)
    low = {k: min((m for m in v if m is not None), default=None) for k, v in members.items()}
    return sorted(((key, len(s), low[top(i)] if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def found(df, **options):
    return sorted((tuple(r) for r in near_dups.similar(df, **options).select("key", "n", "component").collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, key = [], 0
    for size in (12, 40, 150, 600):
        for _ in range(5):
            base = rng.choices(vocabulary, k=size)
            for edits in (0, 0, 1, 1, 2, 3, 5, 8):
                words = list(base)
                for _ in range(edits):
                    words[rng.randrange(size)] = rng.choice(vocabulary)
                rows.append((key, " ".join(words).upper() if edits == 2 else "\t".join(words)))
                key += 1
    # a chain, each text one edit from the next, whose ends do not link
    words = rng.choices(vocabulary, k=80)
    for k in range(25):
        words[3 * k] = f"chain{k}"
        rows.append((key, " ".join(words)))
        key += 1
    rng.shuffle(rows)
    odd = [(None, "a b"), (None, "A\nb"), (7001, "a b"), (None, "lonely words here only once or twice"), (7002, None), (7003, ""), (7004, " \n"),
           (7005, "no\x1cbreak x"), (7006, "x " * 60_000), (7007, "x " * 50_000), (7008, "é é é é é é é"), (None, None)]
    return rows + odd + rows[:4]


def test_components_are_those_of_all_pairs(spark, rows):
    df = spark.createDataFrame([(k, t, i, "s", 2.0) for i, (k, t) in enumerate(rows)], "doc_id long, text string, node int, key string, n double").repartition(3)
    assert found(df) == plain(rows)


def test_other_thresholds(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, percent=95, words=3) == plain(rows, 95, 3)


def test_a_group_gives_no_more_first_pairs_than_nodes(spark, monkeypatch):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join([*words[:k], f"x{k}", *words[k + 1:]]) for k in range(0, 400, 4)]
    asked = []

    def counted(pairs, sets, percent, linked=near_dups.linked):
        asked.append(pairs.count())
        return linked(pairs, sets, percent)

    monkeypatch.setattr(near_dups, "_alike", lambda percent: F.lit(True))
    monkeypatch.setattr(near_dups, "linked", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["component"] for r in near_dups.similar(docs).collect()} == {0}
    assert asked[0] < len(texts)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string")) == []
    assert found(spark.createDataFrame([(1, None)], "doc_id long, text string")) == [(1, 0, 1)]


def test_minhashes_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(1)
    tokens = rng.integers(-(1 << 62), 1 << 62, 20_000)
    a, b = tokens[:18_000], tokens[2_000:]  # Jaccard 0.8
    x, y = near_dups.minhashes(a, 2000), near_dups.minhashes(b, 2000)
    assert abs((x == y).mean() - 0.8) < 0.04
    assert (near_dups.minhashes(a[::-1], 2000) == x).all()  # blocks of tokens in any order


def test_two_sets_at_the_threshold_nearly_always_meet():
    """A left and a right collection agree, so their key is shared."""
    rng = np.random.default_rng(2)
    missed = 0
    for _ in range(300):
        tokens = rng.integers(-(1 << 62), 1 << 62, 185)
        x, y = near_dups.collections_of(tokens[:170]), near_dups.collections_of(tokens[15:])  # Jaccard 155 / 185
        both = x == y
        missed += not (both[:near_dups.COLLECTIONS].any() and both[near_dups.COLLECTIONS:].any())
    assert missed <= 1


def test_parities_never_exclude_a_link():
    rng = np.random.default_rng(4)
    for _ in range(200):
        tokens = rng.integers(-(1 << 62), 1 << 62, 300)
        k = rng.integers(0, 60)
        a, b = np.sort(tokens[:300 - k]), np.sort(tokens[k:])
        apart = int(np.bitwise_count((near_dups.parities(a) ^ near_dups.parities(b)).view(np.uint64)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_shingles_are_those_of_the_contract():
    assert len(shingles("A b\x0bC d e")) == 1 and len(shingles("a b c d e f")) == 2 and (shingles("A B") == shingles("a  b")).all()
