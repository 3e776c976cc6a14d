"""Every label is a class, and copies do not crowd out a language's other texts."""

from __future__ import annotations

import random

from fundpanel.llm import language


def test_more_languages_than_a_cap_and_many_copies(spark):
    rng = random.Random(1)
    rows = [(f"{chr(97 + k % 26)}{chr(97 + k // 26)} text number {i} " * 3, f"l{k:02d}") for k in range(70) for i in range(3)]
    rows += [("a text that stands very often", "l00")] * 5_000
    rng.shuffle(rows)
    df = spark.createDataFrame([*rows, (None, "l99"), ("", "l98"), ("no label", None)], "text string, lang string")
    seen = []

    class Noted(language.ByteNet):
        def train(self, windows, labels):
            seen.append((len(windows), sorted({int(x) for x in labels})))
            return self

    old, language.ByteNet = language.ByteNet, Noted
    try:
        net = language.fit(df, sample=100)
    finally:
        language.ByteNet = old
    assert net.classes == [f"l{k:02d}" for k in range(70)]
    assert seen == [(211, list(range(70)))]  # each different text is one window


def test_a_tie_goes_to_the_first_language():
    net = language.ByteNet(["aa", "bb"])
    net.predict = lambda windows: language.np.full((len(windows), 2), 0.5)
    assert language.predict_texts(net, ["some words", "", None]) == [("aa", 0.5), ("und", 0.0), ("und", 0.0)]
