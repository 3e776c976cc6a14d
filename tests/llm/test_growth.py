"""Steps whose cost must not grow faster than their input."""

from __future__ import annotations

import itertools
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fundpanel.llm import bpe, html, lines, ngram_join, packing, toxicity
from fundpanel.llm.common import UNIT, UnitEncoder, staged

WORD = public_tokenizers.path("word_bpe_49k.json")


class Unwalked(dict):
    """Kept units that may be looked up, but not gone through."""

    def __iter__(self):
        raise AssertionError("all kept units were gone through")

    def keys(self):
        raise AssertionError("all kept units were gone through")


def test_new_units_do_not_walk_the_cache():
    coder, plain = UnitEncoder(WORD), Tokenizer.from_file(WORD)
    coder.encode("some words <b that stay")
    coder.cache, coder.older = {}, Unwalked(coder.cache)
    text = "other words <b that come"
    assert coder.encode(text) == b"".join(i.to_bytes(4, "little") for i in plain.encode(text, add_special_tokens=False).ids)
    assert set(coder.cache) == set(UNIT.findall(text))


def test_plain_words_are_not_kept():
    coder, plain = UnitEncoder(WORD, 20), Tokenizer.from_file(WORD)
    rng = np.random.default_rng(7)
    signs = ["the", "Don't", "we'LL", "'s", "x", "42", "!?", "...", "re", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x01", "A", "Supercalifragilistic", "é", "\u3000", "ÀB", "中文", "\u0301", "Σ", "a\xa0b", "_", "-", "="]
    for k in range(400):
        text = "".join(rng.choice(signs[:18] if k % 2 else signs, 60))
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    for text in ("nul \0 inside é", "\0", "a < b é", "", " ", "="*5000, "é", "é\0"):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    coder = UnitEncoder(WORD)
    coder.encode("Plain words stay out, só does not")
    assert set(coder.cache) == {" só"}


def optimized(df) -> list[str]:
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_lines_are_cut_once_a_text(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, "b\nd\na\ne"), (3, "a\nc"), (4, None), (5, "\na")], "doc_id long, text string")
    cut = lines.without_repeats(docs)
    assert "lambdafunction(split(" not in "".join(optimized(cut))
    assert dict(cut.collect()) == {1: "a\nb\nc", 2: "d\ne", 3: "", 4: None, 5: ""}


def test_only_texts_with_wanted_sets_are_cut_into_words(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "g h i j k l"), (3, "A b c d e f"), (4, None), (5, " ")], "doc_id long, text string")
    signs = ngram_join.signed(docs, "text", "doc_id", 5).filter("kind = 0")
    own = {r["key"]: r["sig"] for r in signs.collect()}
    found = ngram_join.sets_of(docs, "text", signs.filter("n > 0").select("sig"), signs.filter("key <> 2").select("sig", "whole"), 5)
    assert {r["sig"]: len(r["tokens"]) // 6 for r in found.collect()} == {own[1]: 2}
    assert own[1] == own[3]


def test_tokens_move_once(spark):
    docs = spark.createDataFrame([(i, "word " * (i * 37 % 5000)) for i in range(60)], "doc_id long, text string")
    parts = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    packed = packing.pack(parts)
    plan = optimized(packed)
    at = next(k for k, line in enumerate(plan) if "Window [" in line)
    depth = plan[at].index("Window [")
    below = [line for line in itertools.takewhile(lambda line: re.search(r"\w", line).start() > depth, plan[at + 1:])]
    assert below and not any("ids#" in line for line in below if "Relation" not in line)
    rows = packed.collect()
    assert len(rows) == parts.count() and any(r["length"] == packing.SEQUENCE for r in rows)
    assert all(len(r["ids"]) == r["length"] for r in rows)
    for _, own in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), lambda r: r["sequence_id"]):
        at = 0
        for r in own:
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.SEQUENCE


def test_only_labelled_texts_move(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join([*(f"{'bcdfgklmnprst'[(i * k) % 13]}{'aeiou'[(i + k) % 5]}{'bcdfgklmnprst'[(i + 3 * k) % 13]}{'aeiou'[(i * i + k) % 5]}" for k in range(1, 9)), "vile" if i % 2 else "kind"])) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    assert "vile" in toxicity.fit(docs, labels).shares
    monkeypatch.setattr(toxicity, "key_sketch", lambda keys, column: np.zeros(1 << 18, np.uint32).tobytes())
    assert not toxicity.fit(docs, labels).shares


def test_lines_of_marked_pages_do_not_move(spark, monkeypatch):
    """Texts where an article is marked are taken as they are read; others keep their lines."""
    kept = {}
    monkeypatch.setattr(html, "staged", lambda df, name: kept.setdefault(name, staged(df, name)))
    page = "<div>menu</div>%s<p>terms</p>"
    rows = [(1, "http://a.x/1", page % "<article>one</article>"), (2, "http://a.x/2", page % "<p>two</p>"), (3, "http://a.x/3", page % "<article class=ad>three</article><p>four</p>"),
            (4, "http://b.x/1", page % "<main>five</main>"), (5, None, "six")]
    got = {r["key"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "one", 2: "two", 3: "four", 4: "five", 5: "six"}
    assert {r["key"]: r["lines"] for r in kept["pages"].collect()} == {1: None, 2: ["menu", "two", "terms"], 3: ["menu", "three", "four", "terms"], 4: None, 5: None}
    assert "lines" not in kept["shared"].columns


def test_outliers_do_not_meet_a_group_in_every_list(spark, monkeypatch):
    """40 near copies of a set and 20 sets with 17 % of their own tokens are hardly joined,
    against a join on all that is stored; pairs that link are joined as often as they have to be."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**60, 300)
    own = lambda share: np.unique(np.concatenate([base[rng.random(300) >= share], rng.integers(0, 2**60, int(300 * share))]))
    sets = {k: own(0.01 if k < 40 else 0.17 if k < 60 else 0.1) for k in range(80)}
    heavy, counts = np.unique(np.concatenate(list(sets.values())), return_counts=True)
    rows = []
    for k, s in sets.items():
        at, least = ngram_join.prefix_places(s, ngram_join.counted(s, heavy, counts), 75)
        rows += [(int(s[i]), k, len(s), least, n, 0 if k < 40 else k, *ngram_join.parities(s).tolist()) for n, i in enumerate(at)]
    left = spark.createDataFrame(rows, "token long, sig long, n int, l short, at int, component long, " + ", ".join(f"{b} long" for b in ngram_join.BITS))
    found = [tuple(r) for r in ngram_join.paired(left, 75).collect()]
    monkeypatch.setattr(ngram_join, "BEYOND", 1)
    stored = [tuple(r) for r in ngram_join.paired(left, 75).collect()]
    joined, before = (sum(a < 40 <= b < 60 for a, b, *_ in x) for x in (found, stored))
    assert 0 < 5 * joined < before
    times = {p: (sum(q == p for q in found), p[4]) for p in set(found)}
    enough = {p[:2] for p, (n, least) in times.items() if n >= least}
    both = lambda a, b: len(np.intersect1d(sets[a], sets[b]))
    linked = {(a, b) for a, b in itertools.combinations(sets, 2) if b >= 40 and 100 * both(a, b) >= 75 * (len(sets[a]) + len(sets[b]) - both(a, b))}
    assert linked and linked <= enough


def test_encoded_runs_are_kept_small(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(bpe, "staged", lambda *a: kept.append(staged(*a)) or kept[-1])
    shared = " ".join(f"word{i}" for i in range(600))
    docs = spark.createDataFrame([(i, f"own {i} {shared} end {i}") for i in range(4)], "doc_id long, text string")
    assert bpe.encode_decode(docs, WORD).count() == 4
    assert len(kept) == 2 and all(f.endswith(".zstd.parquet") for k in kept for f in k.inputFiles())


@pytest.mark.parametrize("name, own", [("toxicity", set()), ("quality rules", set()), ("line dedup", {"gone"}), ("n-gram Jaccard join", {"kept"}), ("best-fit packing", {"pieces", "packed"})])
def test_stages_leave_only_the_copies_that_their_result_reads(spark, name, own):
    import os

    import corpus_pipeline
    from fundpanel.llm.common import stage_folder

    sf = "/root/testdata/sf0.01"
    folder = stage_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(200)
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, sf)
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before} if os.path.exists(folder) else set()
    assert left == own
    assert 0 < out.count() and out.select(*out.columns).collect()
