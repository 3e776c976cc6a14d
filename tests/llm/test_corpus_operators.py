"""The corpus operators against plain versions, on small tables and on odd rows."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fundpanel.llm import ann, bpe, html, language, lines, ngram_join, packing, quality, sharding, toxicity
from fundpanel.llm.common import UNIT, UnitEncoder, components, key_sketch, numbered, table

SF = "/root/testdata/sf0.001"
WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")

ODD_TEXTS = [
    None, "", " ", "a", "\n\n", "it's a test's   end ", "x" * 70_000, "word " * 3_000, "no\x1cbreak !\x1c!", "<|endoftext|> a<|endoftext|>b <|startoftext|>",
    "é ́x İstanbul ΣΑΣ", "中文　文字", "tab\tand\x0bvt\x85nel", "   three   spaces   ", "emoji \U0001f600\U0001f600", "a   b",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, repeated ids and rows, columns that operators use themselves."""
    rows = [(None if i == 3 else i // 2, t, "en" if i % 3 else None, i, float(i), "x") for i, t in enumerate([*ODD_TEXTS, *ODD_TEXTS])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, key int, score double, row string").repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF, "labels")


def empty(df):
    return df.limit(0)


# helpers


def test_components_are_those_of_a_walk(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 240)]
    edges = [e for e in edges if e[0] != e[1]]
    root = {n: n for e in edges for n in e}
    for _ in range(60):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == root


def test_numbers_have_no_gaps(spark):
    rows = spark.range(500).select(F.col("id").alias("row"), (F.col("id") % 3 == 0).cast("int").alias("g"), F.when(F.col("id") < 200, 7).otherwise(F.col("id")).alias("hub"))
    found = numbered(rows, "g", F.struct("hub", "row"), "k", buckets=8, spread=F.col("hub") == 7).collect()
    for g in (0, 1):
        own = sorted((r["k"], r["hub"]) for r in found if r["g"] == g)
        assert [k for k, _ in own] == list(range(len(own)))
        hubs = [h for h, _ in itertools.groupby(h for _, h in own)]
        assert hubs.count(7) == 1


def test_sketch_has_every_key(spark):
    keys = spark.range(-3000, 3000, 7).select(F.xxhash64("id").alias("h"))
    bits = np.frombuffer(key_sketch(keys, "h", bits=14), np.uint32)
    from fundpanel.llm.common import in_sketch

    assert in_sketch(bits, np.array([r["h"] for r in keys.collect()], np.int64)).all()
    assert not in_sketch(np.frombuffer(key_sketch(keys.limit(0), "h", bits=14), np.uint32), np.arange(100, dtype=np.int64)).any()


# 1


def _search(spark, rows, k=5, **more):
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, block int, rank int")
    return ann.search(v, v.filter("vec_id % 3 = 0"), k=k, **more)


def test_neighbours_on_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [math.cos(i * 1.0), math.sin(i * 1.0), i % 5 - 2.0, 0.5]) for i in range(30)]
    copies = [(i, [1.0, 0.0, 2.0, 0.5]) for i in range(100, 140)]
    bad = [(200, None), (201, []), (202, [0.0] * 4), (203, [1.0, None, 0.0, 1.0]), (204, [nan, 1.0, 1.0, 1.0]), (205, [inf, 1.0, 1.0, 1.0]), (None, [1.0] * 4), (206, [1.0, 2.0])]
    rows = [(i, v, 1, 2) for i, v in [*good, *copies, *bad, good[4], copies[7]]]
    found = collections.defaultdict(list)
    for r in _search(spark, rows, target=1.0).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["rank"], r["id"], r["score"]))
    plain = {i: np.array(v, np.float32).astype(float) for i, v in [*good, *copies]}
    assert set(found) == {i for i in plain if i % 3 == 0}
    for q, got in found.items():
        want = sorted(((-float((plain[q] * v).sum()), i) for i, v in plain.items() if i != q))[:5]
        assert [(k, i) for k, i, _ in got] == [(k + 1, i) for k, (_, i) in enumerate(want)]
        assert all(s == -w for (_, _, s), (w, _) in zip(got, want, strict=True))


def test_neighbours_few_and_none(spark):
    assert _search(spark, [(0, None, 0, 0)]).count() == 0
    assert [(r["query_id"], r["id"]) for r in _search(spark, [(0, [1.0, 2.0], 0, 0), (1, [1.0, -2.0], 0, 0)]).collect()] == [(0, 1)]
    assert _search(spark, [(0, [1.0, 2.0], 0, 0)]).count() == 0


def test_a_small_share_still_gives_k_rows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "calibrated", lambda *a: 0.0)
    got = collections.Counter(r["query_id"] for r in ann.search(df, df.filter("vec_id < 20"), k=20).collect())
    assert got == dict.fromkeys(range(20), 20)


def test_recall_against_all_pairs(spark):
    v = table(spark, SF, "embeddings")
    rows = v.orderBy("vec_id").collect()
    x, ids = np.array([r["embedding"] for r in rows], float), np.array([r["vec_id"] for r in rows])
    found = collections.defaultdict(set)
    for r in ann.search(v, v.filter("vec_id % 20 = 0")).collect():
        found[r["query_id"]].add(r["id"])
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        order = [j for j in np.argsort(-(x @ x[i]), kind="stable") if j != i][:20]
        hits, total = hits + len(found[ids[i]] & set(ids[order])), total + 20
    assert hits / total >= 0.9


def test_cells_are_visited_in_order():
    rng = np.random.default_rng(0)
    books = ann.Codebooks(rng.normal(size=(300, 6)), 8)
    q = rng.normal(size=6)
    cells = list(books.visit(q))
    scores = [float(books.books[0][c // 8] @ q[:3] + books.books[1][c % 8] @ q[3:]) for c in cells]
    assert sorted(cells) == list(range(64)) and scores == sorted(scores, reverse=True)


# 2


def _plain_bpe(texts):
    t = Tokenizer.from_file(WORD)
    return [(ids := t.encode(x or "", add_special_tokens=False).ids, t.decode(ids, skip_special_tokens=False)) for x in texts]


@pytest.mark.parametrize("mean", [16, 512])
def test_encoding_agrees_with_the_library(spark, docs, odd, mean):
    for frame in (odd, docs):
        rows = frame.collect()
        want = collections.Counter((r["doc_id"], tuple(ids), text) for r, (ids, text) in zip(rows, _plain_bpe(r["text"] for r in rows), strict=True))
        got = collections.Counter((r["key"], tuple(r["ids"]), r["decoded"]) for r in bpe.encode_decode(frame, WORD, mean=mean).collect())
        assert got == want
    assert bpe.encode_decode(empty(docs), WORD).count() == 0


def test_chunks_are_the_text_and_follow_content():
    rng = random.Random(1)
    text = "".join(rng.choice("abcdeé \n") for _ in range(30_000)).encode()
    parts = bpe.chunks(text, 256)
    assert b"".join(parts) == text and all(c.decode() for c in parts) and 100 < len(parts) < 1000
    moved = bpe.chunks(b"something in front " + text, 256)
    assert len(set(parts) & set(moved)) >= len(set(parts)) - 2
    assert b"".join(bpe.chunks("é".encode() * 100_000)) == "é".encode() * 100_000 and bpe.chunks(b"") == []


def test_joins_are_repaired():
    coder = UnitEncoder.of(WORD)
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice(["a", "the", " ", "  ", "'", "s", "!", "\n", "9", "é", "<|endoftext|>", " "]) for _ in range(rng.randrange(40)))
        cuts = sorted(rng.randrange(len(text) + 1) for _ in range(rng.randrange(6)))
        runs = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]
        if "<|" in text and any("<|" in r + s and "<|" not in r and "<|" not in s for r, s in itertools.pairwise(runs)):
            pass
        joined = bpe.join_runs([(h, coder.encode(c), t, s) for h, c, t, s in map(bpe.open_ends, runs)], coder)
        assert np.frombuffer(joined, "<u4").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_units_encode_like_whole_texts(path):
    coder = UnitEncoder(path, keep=50)
    for t in ODD_TEXTS:
        assert "".join(UNIT.findall(t or "")) == (t or "")
        assert np.frombuffer(coder.encode(t or ""), "<u4").tolist() == coder.tokenizer.encode(t or "", add_special_tokens=False).ids


# 3


def test_language_on_held_out_texts(spark):
    rows = table(spark, "/root/testdata/sf0.01", "documents").withColumn("h", F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    net = language.fit(rows.filter("not h"))
    got = rows.filter("h").select("lang", language.predicted(net, F.col("text")).alias("p")).collect()
    assert sum(r["lang"] == r["p"]["lang"] for r in got) / len(got) > 0.97
    assert all(0 <= r["p"]["score"] <= 1 for r in got)


def test_language_of_odd_texts(spark, odd, docs):
    net = language.fit(docs)
    got = odd.select("text", language.predicted(net, F.col("text")).alias("p")).collect()
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["p"]["lang"] in net.classes) == letters
        assert letters or tuple(r["p"]) == ("und", 0.0)
    none = language.fit(empty(docs))
    assert {r[0]["lang"] for r in docs.select(language.predicted(none, F.col("text"))).collect()} == {"und"}
    assert empty(docs).select(language.predicted(net, F.col("text"))).count() == 0


def test_windows_cover_the_whole_text():
    raw = bytes(range(1, 256)) * 5
    w = language.windows_of(raw)
    assert w.reshape(-1)[:len(raw)].tobytes() == raw and not w.reshape(-1)[len(raw):].any()


# 4


@pytest.fixture(scope="module")
def cost(spark):
    return toxicity.language_model(table(spark, "/root/testdata/sf0.01", "documents"))


@pytest.mark.parametrize("written", ["1d10t", "id!ot", "i.d.i.o.t", "i-d-i-o-t", "idiooooot", "IDIOT!!", "(idiot)", "1d1ooot"])
def test_words_are_restored(cost, written):
    assert "idiot" in toxicity.Restorer(cost).words(f"the {written} and")


def test_spread_words_are_restored(cost):
    assert "idiot" in toxicity.Restorer(cost).words("so i d i o t was")
    assert toxicity.Restorer(cost).words("the was from") == {"the", "was", "from"}


def test_toxic_texts_are_caught_and_clean_ones_left(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    model = toxicity.fit(docs, labels.filter(fold != 1))
    got = docs.filter(fold == 1).join(labels, "doc_id").select("toxic", toxicity.scored(model, F.col("text")).alias("s")).collect()
    caught = sum(r["s"] >= 0.7 for r in got if r["toxic"]) / sum(r["toxic"] for r in got)
    false = sum(r["s"] >= 0.7 for r in got if not r["toxic"]) / sum(not r["toxic"] for r in got)
    # some 280 toxic labels: stems of which fewer than eight texts are labelled are not learned
    assert caught > 0.75 and false < 0.01
    hidden = spark.createDataFrame([("In the w0rthl3ss of",), ("In the s t u p i d of",), ("In the of",), ("",), (None,)], "t string")
    scores = [r[0] for r in hidden.select(toxicity.scored(model, F.col("t"))).collect()]
    assert min(scores[:2]) >= 0.7 and max(scores[2:]) == 0


def test_skipped_words_have_no_reading_that_counts(cost):
    """Every look-alike and separator at every place of a word, in place of a letter or
    between two: scores with and without the filter are equal."""
    model = toxicity.Model(cost, {"idiot": 0.9, "stupid": 0.8, "stup…": 0.95, "moron": 0.85, "worth…": 0.75, "st*ker": 0.7, "as": 0.6})
    words = ["idiot", "stupid", "moron", "worthless", "st*ker", "hello"]
    written = [w[:i] + c + w[i + k:] for w in words for c in {*toxicity.LOOKS, *toxicity.SEPARATORS} for i in range(len(w) + 1) for k in (0, 1)]
    written += ["s*t*u*p*i*d", "st**pid", "*d*ot", "m*r*n", "***", "*", "r@$", "hello,st*ker!", "id!ot)stup*d"]
    every, some = toxicity.Restorer(cost), toxicity.Restorer(cost, model.shares)
    for w in written:
        assert toxicity.score_text(model, some, w) == toxicity.score_text(model, every, w), w
    assert all(toxicity.score_text(model, some, w) > 0.7 for w in ("st*pid", "the st*pid one", "m*ron", "stup*d"))


INSULTS = {"idiot": 0.9, "stupid": 0.8, "stup…": 0.95, "idio…": 0.9, "loser": 0.9, "trash": 0.9, "scum": 0.9, "oaf": 0.9}


@pytest.mark.parametrize("written", [
    "what a s t u p i d thing", "s t u p i d i d i o t", "hello,stupid", "you/idiot", "hello!stupid", "hello,id.iot", "you l o s e r", "a t r a s h",
    "(s t u p i d!)", "it's a t r a s h", "a.s.t.u.p.i.d", "s t u u u p i d", "$ t u p ! d", "s - t - u - p - i - d", "an o a f", "word " * 60 + "aGk/" * 150 + " s c u m"])
def test_words_are_found_between_limits(cost, written):
    model = toxicity.Model(cost, INSULTS)
    assert toxicity.score_text(model, toxicity.Restorer(cost, INSULTS), written) >= 0.9
    assert toxicity.score_text(model, toxicity.Restorer(cost), written) >= 0.9


def test_likeliest_words_of_a_run(cost):
    words = toxicity.Restorer(cost).words
    assert words("s.t.u.p.i.d.i.d.i.o.t") == {"stupid", "idiot"}
    assert words("so s t u p i d i d i o t was") == {"so", "was", "stupid", "idiot", *"stupdio"}


@pytest.mark.parametrize("written", [
    "st" + "u" * 50 + "pid", "s" + "." * 90 + "t.u" + "." * 9 + "p.i.d", "+hello,(stupid+", "idio+", "(lown", "\"(lown!!!", "(idio+)", "$cum#", "cl0wn!!!", "hello," * 60 + "st" + "u" * 70_000 + "pid"])
def test_length_and_edges_hide_nothing(cost, written):
    shares = INSULTS | {"clown": 0.9}
    for wanted in (shares, None):
        assert toxicity.score_text(toxicity.Model(cost, shares), toxicity.Restorer(cost, wanted), written) >= 0.9


def test_long_words_are_read_in_linear_time(cost):
    for w in ("-" * 200_000 + "a", "ab1" * 30_000, "a-" * 30_000, "\u4e2d\u4e2d\u6587" * 30_000):
        toxicity.score_text(toxicity.Model(cost, INSULTS), toxicity.Restorer(cost), w)


def test_limits_alone_make_no_insult(cost):
    model = toxicity.Model(cost, INSULTS)
    for written in ("w e l l", "a b c", "http://a.b/x-y_z", "well-known don't e.g. 1,000.5", "a - b", "\u200b", "$ ! (", ""):
        assert toxicity.score_text(model, toxicity.Restorer(cost, INSULTS), written) == 0


def test_frequent_words_stay_in_a_full_cache(cost, monkeypatch):
    """Words of a cache that is full are not all forgotten: what each text has is read once."""
    read, plain = collections.Counter(), toxicity.restore
    monkeypatch.setattr(toxicity, "restore", lambda word, *rest: read.update([word]) or plain(word, *rest))
    restorer = toxicity.Restorer(cost, keep=100)
    for i in range(300):
        assert "often" in restorer.words(f"often, (often) often. once{i}x")
    assert read["often"] == 1 and len(restorer.cache.new) + len(restorer.cache.old) <= 100


def test_words_that_lead_nowhere_are_not_kept(cost):
    model, restorer = toxicity.Model(cost, INSULTS), toxicity.Restorer(cost, INSULTS)
    assert toxicity.score_text(model, restorer, "when, 'dumb' zebra. stupid") >= 0.8
    assert set(restorer.scores.new) == {"stupid"}


def test_toxicity_of_odd_rows(spark, odd, labels):
    own = spark.createDataFrame([(0, 1), (1, 0), (2, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    kept = toxicity.clean_documents(odd, own)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert toxicity.clean_documents(empty(odd), own).count() == 0
    assert toxicity.clean_documents(odd, empty(own)).count() == odd.count()


# 5


def _check_packing(rows, texts, size=2048):
    coder = Tokenizer.from_file(BYTE)
    by_doc, by_bin = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["key"]].append(r)
        by_bin[r["sequence_id"]].append(r)
    for d, t in texts.items():
        ids = [*coder.encode(t or "", add_special_tokens=False).ids, 0]
        own, at = sorted(by_doc.pop(d), key=lambda r: r["piece"]), 0
        for k, r in enumerate(own):
            part = np.array(ids[at:at + r["length"]], "<u4")
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(part.tobytes()))
            assert k == 0 or r["length"] == size
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    for own in by_bin.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
    return len(by_bin)


def test_packing_is_whole_and_tight(spark, docs):
    parts = packing.pieces(docs, BYTE)
    rows = packing.pack(parts).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    bins = _check_packing(rows, texts)
    total = sum(r["length"] for r in rows)
    assert bins <= 1.02 * math.ceil(total / 2048) + 1
    assert all(len(r["ids"]) == r["length"] for r in rows)


def test_packing_of_odd_rows(spark, odd):
    assert packing.pack(packing.pieces(empty(odd), BYTE)).count() == 0
    one = odd.dropDuplicates(["key"]).drop("doc_id").withColumnRenamed("key", "doc_id")
    _check_packing(packing.pack(packing.pieces(one, BYTE)).collect(), {r["doc_id"]: r["text"] for r in one.collect()})
    assert packing.pack(packing.pieces(odd, BYTE)).agg(F.sum("length")).first()[0] == packing.pieces(odd, BYTE).agg(F.sum("length")).first()[0]


def test_crossover_keeps_every_item():
    rng = random.Random(5)
    sizes = np.array([rng.randrange(1, 900) for _ in range(400)])
    a, b = packing.best_fit(list(range(400)), sizes, 1000), packing.best_fit(list(range(0, 400, 2)), sizes, 1000)
    b = packing.best_fit(list(range(1, 400, 2)), sizes, 1000, *b)
    for _ in range(5):
        b = packing.crossover(a, b, sizes, 1000, rng)
        assert sorted(i for own in b[0] for i in own) == list(range(400))
        assert all(sizes[own].sum() == 1000 - f and f >= 0 for own, f in zip(*b, strict=True))


def test_blocks_are_merged(spark):
    rng = random.Random(6)
    sizes = [rng.randrange(300, 1200) for _ in range(3000)]
    items = spark.createDataFrame(list(enumerate(sizes)), "n long, size int")
    bins = collections.Counter()
    for r in packing.pack_sizes(items, 2048, block=400).collect():
        bins[r["bin"]] += sizes[r["n"]]
    assert sum(bins.values()) == sum(sizes) and max(bins.values()) <= 2048
    assert len(bins) <= 1.01 * packing_best(sizes)


def test_evolution_saves_bins_where_best_fit_is_above_the_bound():
    sizes = np.random.default_rng(3).integers(500, 900, 1200)
    plain = len(packing.best_fit(list(range(len(sizes))), sizes, 2048)[0])
    own = packing.evolve(sizes, 2048, 7, None, None)
    assert np.bincount(own, weights=sizes).max() <= 2048
    assert len(set(own)) <= 0.97 * plain


def test_exchanges_keep_every_item():
    rng = random.Random(4)
    for _ in range(50):
        sizes = [rng.randint(1, 900) for _ in range(60)]
        bins, free = packing.best_fit(list(range(30)), np.array(sizes), 1000)
        before = sum(free)
        left = packing.exchange(bins, free, list(range(30, 60)), sizes)
        assert sorted([*left, *itertools.chain(*bins)]) == list(range(60))
        assert [1000 - sum(sizes[i] for i in b) for b in bins] == free and min(free) >= 0 and sum(free) <= before


def test_encoder_is_that_of_whole_texts_and_keeps_little():
    texts = [*(t or "" for t in ODD_TEXTS), " ".join(f"w{i}x <b>{i}</b> don't  é{i}" for i in range(700)), " a< |b <|endoftext|>c\n\n"]
    for path in (WORD, BYTE):
        coder, plain = UnitEncoder(path, 500), Tokenizer.from_file(path)
        for t in [*texts, *texts]:
            assert np.frombuffer(coder.encode(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids
    assert all("<" in u for u in coder.cache)


def packing_best(sizes):
    return len(packing.best_fit(list(range(len(sizes))), np.array(sizes), 2048)[0])


# 6

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header class="top">Site &amp; Co</header><nav><ul><li><a href="/a">Home</a></li></ul></nav>%s<article><h1>Head &eacute;</h1><p>One  <b>bold</b>ly
two<br>three<div class="ad">buy</div><p>four &#8212; five<form><input value="x">send</form><aside>side</aside><section id="comments"><p>me too</p></section></article>
<footer>&copy; x</footer><!-- end --></body></html>"""
WANT = "Head é One boldly two three four — five"


def test_pages(spark):
    plain = "<body><div>Shop menu</div><div>%s</div><p>terms apply</p><div class='cookie-notice'>ok?</div></body>"
    rows = [
        (1, "http://a.x/en/1", PAGE % "<div>promo</div>"), (2, "http://a.x/en/2", PAGE % ""),
        (3, "http://b.x/p/1.html", plain % "first story"), (4, "http://b.x/p/2.html", plain % "second &lt;story&gt;"),
        (5, None, None), (6, "http://c.x/", ""), (7, "nothing", "just text & more <"), (7, "nothing", "just text & more <"), (None, "http://d.x/", "<p>a<p>b<!-- open"),
    ]
    got = collections.Counter((r["key"], r["url"], r["text"]) for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert got[1, "http://a.x/en/1", WANT] == 1 and got[2, "http://a.x/en/2", WANT] == 1
    assert got[3, "http://b.x/p/1.html", "first story"] == 1 and got[4, "http://b.x/p/2.html", "second <story>"] == 1
    assert got[5, None, ""] == 1 and got[6, "http://c.x/", ""] == 1 and got[None, "http://d.x/", "a b"] == 1
    assert sum(got.values()) == len(rows)
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_copies_and_partition_edges_lose_no_text(spark, monkeypatch, parts):
    """Copies, at one URL or beside each other, have the text that one of them has; the
    neighbour is the same however pages are dealt."""
    monkeypatch.setattr(html, "HEAVY", 3)
    plain = "<div>Menu</div><div>%s</div><p>terms</p>"
    rows = [(i, f"http://a.x/p/{i // 2:03d}.html", plain % f"story {i // 4}") for i in range(60)]
    rows += [(100 + i, "http://b.x/", "<p>alone</p>") for i in range(9)]
    rows += [(200 + i, None, plain % "none") for i in range(3)] + [(300 + i, "no url", plain % "none") for i in range(2)]
    settings = {"spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    former = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = {r["key"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)).collect()}
    finally:
        for k, v in former.items():
            spark.conf.set(k, v)
    want = {i: f"story {i // 4}" for i in range(60)} | {100 + i: "alone" for i in range(9)}
    assert got == want | {i: "Menu none terms" for i in (200, 201, 202, 300, 301)}


@pytest.mark.parametrize("before,after", [
    ("<div class='layout has-sidebar'><article>", "</article></div>"), ("<div id='page-with-nav'><main>", "</main></div>"), ("<form action='/'><article>", "</article></form>"),
    ("<div class='widget-area content'><div class='with-footer'><article>", "</article></div></div>"), ("<div class='has-sidebar'><div role=main>", "</div><div class='related'><article>teaser</article></div></div>")])
def test_wrappers_hide_no_article(before, after):
    page = f"<nav>n</nav><header>h</header>{before}<h1>Head</h1><p class='share-price'>up</p><p class='search-result'>two</p><p class=ad>buy</p><div class='share-bar'>x</div><div hidden>y</div>{after}<footer>f</footer>"
    assert html.main_text(html.read_page(page), None) == "Head up two"


def test_teasers_do_not_displace_an_unmarked_text():
    page = "<p>a long text without any article element</p><div class='related'><article>teaser</article></div><form><input>go</form>"
    assert html.main_text(html.read_page(page), None) == "a long text without any article element"
    both = "<article>own</article><div class='related'><article>a longer teaser than the text</article></div>"
    assert html.main_text(html.read_page(both), None) == "own"


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(7)

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(12))] for _ in range(2))
        got = sorted(html.shared_lines(a, b))
        assert len(got) == lcs(a, b)
        it = iter(b)
        assert all(any(a[k] == y for y in it) for k in got)


def test_article_texts_of_given_pages(spark):
    import html as plain
    import re

    pages = table(spark, SF, "pages")
    want = {}
    for r in pages.collect():
        own = " ".join(re.findall(r"<article>(.*?)</article>", r["html"], re.S))
        own = re.sub(r"</?(?:p|h1|br|li|ul|div)\b[^>]*>", " ", re.sub(r"<!--.*?-->", "", own))
        want[r["page_id"]] = " ".join(plain.unescape(re.sub(r"<[^>]*>", "", own)).split())
    assert {r["key"]: r["text"] for r in html.extract(pages).collect()} == want


# 7


def _check_shards(rows, frame):
    counts = collections.Counter(r["shard"] for r in rows)
    assert max(counts[s] for s in range(16)) - min(counts[s] for s in range(16)) <= 1
    for s in range(16):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    want = collections.Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in frame.collect())
    assert collections.Counter((r["key"], r["size"], r["text_crc32"]) for r in rows) == want


def test_shards_are_even_and_groups_stay(spark, docs, odd):
    rows = sharding.shard(docs).collect()
    _check_shards(rows, docs)
    shards = collections.defaultdict(set)
    for r in rows:
        shards[r["text_crc32"]].add(r["shard"])
    assert sum(len(s) > 1 for s in shards.values()) <= 2
    _check_shards(sharding.shard(odd).collect(), odd)
    assert sharding.shard(empty(docs)).count() == 0


def test_a_group_larger_than_a_shard_is_cut_as_little_as_needed(spark):
    rows = spark.range(960).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 320, "same").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = sharding.shard(rows).collect()
    _check_shards(got, rows)
    same = {r["shard"] for r in got if r["text_crc32"] == zlib.crc32(b"same")}
    assert len(same) <= 8  # 320 rows fill 6 shards of 60


# 8


def _plain_components(texts, words=5, percent=75):
    sets = {}
    for d, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[d] = frozenset([tuple(w)] if 0 < len(w) < words else [tuple(w[i:i + words]) for i in range(len(w) - words + 1)]) if w else frozenset()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {d: (len(sets[d]), find(d)) for d in sets}


def _near_copies(seed, groups=6, size=25):
    rng, out = random.Random(seed), {}
    shared = [f"p{i}" for i in range(40)]
    for g in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 8, 60, 150]))] + (shared if g % 2 else [])
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            out[len(out)] = " ".join(own)
    return out


@pytest.mark.parametrize("often", [1, 3])
def test_links_are_those_of_all_pairs(spark, docs, monkeypatch, often):
    monkeypatch.setattr(ngram_join, "OFTEN", often)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    more = _near_copies(8)
    for own in (texts, more):
        frame = spark.createDataFrame(list(own.items()), "doc_id long, text string").repartition(4)
        got = {r["key"]: (r["n"], r["component"]) for r in ngram_join.similar(frame).collect()}
        assert got == _plain_components(own)


@pytest.mark.parametrize("hot, salts", [(2, 3), (10, 64)])
def test_links_do_not_depend_on_how_hot_lists_are_dealt(spark, monkeypatch, hot, salts):
    monkeypatch.setattr(ngram_join, "HOT", hot)
    monkeypatch.setattr(ngram_join, "SALTS", salts)
    texts = _near_copies(12, groups=4, size=60)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r["key"]: (r["n"], r["component"]) for r in ngram_join.similar(frame).collect()}
    assert got == _plain_components(texts)


def test_prefixes_share_as_many_tokens_as_asked():
    rng = np.random.default_rng(9)
    heavy = np.unique(rng.integers(0, 400, 60))
    counts = rng.integers(2, 5000, len(heavy))
    tried = 0
    for _ in range(400):
        a = np.unique(rng.integers(0, 400, rng.integers(1, 60)))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 400, rng.integers(0, 5))]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 75 * (len(a) + len(b) - both):
            (p, l), (q, m) = ngram_join.prefix(a, heavy, counts), ngram_join.prefix(b, heavy, counts)
            assert len(np.intersect1d(p, q)) >= min(l, m)
            tried += 1
    assert tried > 50


def test_parities_differ_in_no_more_places_than_sets():
    rng = np.random.default_rng(4)
    for _ in range(300):
        a, b = (np.unique(rng.integers(-(2**62), 2**62, rng.integers(0, 400))) for _ in range(2))
        b = np.unique(np.concatenate([b[:40], a[rng.random(len(a)) < 0.8]]))
        differ = sum(int(x).bit_count() for x in (ngram_join.parities(a) ^ ngram_join.parities(b)).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b))


def test_joins_of_odd_rows(spark, odd):
    got = ngram_join.similar(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        assert r["n"] > 0 or r["component"] == r["key"]
    assert ngram_join.similar(empty(odd)).count() == 0
    kept = ngram_join.one_of_each(odd)
    assert kept.columns == odd.columns
    texts = [r["text"] for r in kept.collect()]
    blank = [t for t in texts if not (t or "").encode().split()]
    sets = [ngram_join.signature(ngram_join.shingles(t)) for t in texts if (t or "").encode().split()]
    assert len(blank) == 2 * sum(not (t or "").encode().split() for t in ODD_TEXTS)
    assert len(sets) == len(set(sets)) == len({ngram_join.signature(ngram_join.shingles(t)) for t in ODD_TEXTS if (t or "").encode().split()})
    assert ngram_join.one_of_each(empty(odd)).count() == 0


def test_one_document_of_each_group_stays(spark):
    texts = _near_copies(10)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in ngram_join.one_of_each(frame).collect()) == sorted({c for _, c in _plain_components(texts).values()})


# 9


def _plain_measures(t):
    import re

    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    counts = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if counts[tuple(w[i:i + 3])] > 1 for k in range(3)}
    own = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(own) - len(set(own)), len(covered)


def test_measures_agree_with_plain_ones(docs):
    rng = random.Random(4)
    made = ["".join(rng.choice(["a ", "b ", "c#", "\n", "é|", " ", " "]) for _ in range(rng.randrange(60))) for _ in range(200)]
    for t in [*ODD_TEXTS, *made, *[r["text"] for r in docs.collect()]]:
        assert quality.measure(t)[:5] == _plain_measures(t)


def test_bounds_are_exact():
    from math import comb

    for k, n in ((0, 10), (2, 30), (5, 50), (49, 50)):
        p = quality.upper_bound(k, n, 0.95)
        assert abs(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) - 0.05) < 1e-6
    assert quality.upper_bound(5, 5, 0.95) == 1.0 == quality.upper_bound(0, 0, 0.95)


def test_cutoffs_hold_their_risk():
    good, bad = np.zeros(201, int), np.zeros(201, int)
    good[:5], bad[100:] = 400, 3
    assert 5 <= quality.choose_cutoff(good, bad, 0.01, 0.001) <= 100
    good[150] = 200  # a tenth of the good ones would go below this
    assert quality.choose_cutoff(good, bad, 0.01, 0.001) > 150
    assert quality.choose_cutoff(good // 100, bad, 0.01, 0.001) is None
    rng, lost = np.random.default_rng(1), []
    share = np.concatenate([np.full(20, 0.045), np.full(181, 0.1 / 181)])
    for _ in range(200):
        cut = quality.choose_cutoff(rng.multinomial(1500, share / share.sum()), rng.multinomial(300, np.full(201, 1 / 201)), 0.02, 0.05, care=0.0)
        lost.append(0 if cut is None else share[cut:].sum() / share.sum())
    assert np.mean(np.array(lost) > 0.02) <= 0.08


def test_quality_of_odd_rows(spark, odd):
    own = spark.createDataFrame([(0, 1), (1, 0), (2, None), (None, 1), (99, 1)], "doc_id long, quality int")
    kept = quality.kept_documents(odd.withColumn("measures", F.lit(1)), own)
    assert kept.columns == [*odd.columns, "measures"] and kept.filter("text is null").count() == 0
    assert quality.kept_documents(empty(odd), own).count() == 0
    assert quality.kept_documents(odd, empty(own)).count() == kept.count()


def test_bad_documents_go_and_good_ones_stay(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    m = quality.measures(docs)
    cutoffs = quality.fit(m, labels)
    got = m.join(labels, F.col("_key") == F.col("doc_id")).filter(~quality.base_failed("_m")).select("quality", quality.verdict(cutoffs, "_m", F.col("_stratum")).alias("k")).collect()
    good, bad = [r["k"] for r in got if r["quality"] == 1], [r["k"] for r in got if r["quality"] == 0]
    assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.6


# 10


def _plain_lines(rows):
    """Earliest of each class stays; rows of (id, text)."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, lines.xxhash.xxh3_64_intdigest((r[1] or "").encode()) - (1 << 63)))
    own = [(d, t, k, tuple(w)) for d, t in order for k, w in lines.lines_of(t)]
    kinds = list(dict.fromkeys(w for *_, w in own))
    root = {w: w for w in kinds}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(kinds, 2):
        if min(len(a), len(b)) >= lines.NEAR_WORDS and lines.within_one_edit(list(a), list(b)):
            root[find(b)] = find(a)
    first, gone = {}, collections.defaultdict(set)
    for d, t, k, w in own:
        if first.setdefault(find(w), (d, t, k)) != (d, t, k):
            gone[d, t].add(k)
    return collections.Counter((d, t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d, t])) for d, t in rows)


def _line_rows(seed=12):
    rng, rows = random.Random(seed), []
    bases = [[f"w{rng.randrange(500)}" for _ in range(n)] for n in (2, 5, 6, 7, 9, 20, 60)]
    for d in range(60):
        text = []
        for _ in range(rng.randrange(6)):
            w = list(rng.choice(bases))
            kind = rng.randrange(5)
            if kind == 1:
                w[rng.randrange(len(w))] = f"y{rng.randrange(40)}"
            elif kind == 2:
                del w[rng.randrange(len(w))]
            elif kind == 3:
                w.insert(rng.randrange(len(w) + 1), f"z{rng.randrange(40)}")
            text.append(rng.choice([" ", "  "]).join(w))
            if rng.random() < 0.2:
                text.append("  ")
        rows.append((d, "\n".join(text)))
    return rows


def test_lines_are_those_of_all_pairs(spark):
    rows = [*_line_rows(), (None, "w1 w2"), (5, None), (5, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = collections.Counter((r["doc_id"], r["text"]) for r in lines.without_repeats(frame).collect())
    assert got == _plain_lines(rows)


def test_lines_of_odd_rows(spark, odd):
    got = lines.without_repeats(odd)
    assert got.columns == odd.columns
    assert collections.Counter((r["doc_id"], r["text"]) for r in got.collect()) == _plain_lines([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert lines.without_repeats(empty(odd)).count() == 0


def test_neighbourhoods_meet_within_one_edit():
    rng = random.Random(13)
    for _ in range(500):
        a = [str(rng.randrange(4)).encode() for _ in range(rng.randrange(6, 10))]
        b = list(a)
        k = rng.randrange(len(b))
        match rng.randrange(3):
            case 0:
                b[k] = b"9"
            case 1:
                del b[k]
            case 2:
                b.insert(k, b"9")
        assert lines.within_one_edit(a, b) and lines.within_one_edit(b, a)
        assert set(lines.variants(a).tolist()) & set(lines.variants(b).tolist())
        assert set(lines.half_keys(a, b" ".join(a))) & set(lines.half_keys(b, b" ".join(b)))
    assert not lines.within_one_edit([b"a", b"b", b"c"], [b"b", b"a", b"c"])


# queries


def test_digests_of_the_encoding_query(spark):
    from fundpanel.llm.queries import op2_bpe_chunk_reuse

    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in op2_bpe_chunk_reuse(spark, SF).collect()}
    for d, (ids, text) in zip(texts, _plain_bpe(texts.values()), strict=True):
        assert got[d] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "line dedup", "n-gram Jaccard join", "best-fit packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty(docs), SF).columns == docs.columns
    out = corpus_pipeline.run(spark, SF)
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
    assert 0 < out.select("doc_id").distinct().count() < docs.count()


def test_ngram_join_brings_frequent_tokens_as_columns(docs, monkeypatch):
    def refused(*_):
        raise AssertionError("row objects on the driver")

    monkeypatch.setattr(type(docs), "toPandas", refused)
    assert ngram_join.similar(docs).count() == docs.count()
