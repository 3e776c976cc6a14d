"""The registered queries on the smallest given tables: against their SQL, or against what
the contract says of them."""

from __future__ import annotations

import collections
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fundpanel.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    answer = con.execute(SQL[name])
    names = [d[0] for d in answer.description]
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in answer.fetchall()), key=repr)
    assert sorted(names) == columns
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == want


# The other queries against the contract's own definitions.


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def answer(spark):
    """Rows of a query, run once."""
    done = {}

    def of(name):
        if name not in done:
            df = QUERIES[name](spark, SF)
            done[name] = (dict(df.dtypes), df.collect())
        return done[name]

    return of


def crc(text):
    return zlib.crc32((text or "").encode())


def fold(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_op1_finds_nearly_all_nearest(spark, answer):
    types, rows = answer("op1_multi_index_search")
    assert types == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    vectors = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    ids = np.array(sorted(vectors))
    matrix = np.stack([vectors[i] for i in ids])
    found, wanted = 0, 0
    for q in (i for i in ids if i % 20 == 0):
        own = sorted((r for r in rows if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert all(r["score"] == pytest.approx(float(vectors[q] @ vectors[r["vec_id"]]), rel=1e-12) for r in own)
        assert [(r["score"], -r["vec_id"]) for r in own] == sorted(((r["score"], -r["vec_id"]) for r in own), reverse=True)
        scores = matrix @ vectors[q]
        best = [i for _, i in sorted((-s, i) for s, i in zip(scores, ids, strict=True) if i != q)[:20]]
        found, wanted = found + len(set(best) & {r["vec_id"] for r in own}), wanted + 20
    assert found >= 0.9 * wanted


def test_op3_holds_out_a_fold(documents, answer):
    types, rows = answer("op3_language_id")
    assert types == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"} and len(rows) == len(documents)
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and any(c.isalpha() for c in documents[r["doc_id"]]["text"] or "")]
    assert sum(r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in held) > 0.8 * len(held)


def test_op4_predicts_by_its_cutoff(documents, answer):
    types, rows = answer("op4_toxicity")
    assert types == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"} and len(rows) == len(documents)
    assert all(r["held_out"] == (fold(r["doc_id"], 3) == 1) and r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)


def test_op5_packs_every_id_once(documents, answer):
    _, rows = answer("op5_best_fit_packing")
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for d, doc in documents.items():
        ids = np.array([*coder.encode(doc["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by_doc[d], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids)
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
        assert len(own) == -(-len(ids) // 2048) and all(r["length"] == 2048 for r in own[1:])
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048


def test_op6_counts_code_points(spark, answer):
    types, rows = answer("op6_page_text")
    assert types == {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}
    assert sorted(r["page_id"] for r in rows) == sorted(r["page_id"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect())
    assert all(r["n_chars"] == len(r["text"]) and "  " not in r["text"] and r["text"] == r["text"].strip() for r in rows)


def test_op7_keeps_shards_even(documents, answer):
    _, rows = answer("op7_balanced_shards")
    shards = {}
    for r in rows:
        text = documents[r["doc_id"]]["text"]
        assert r["size"] == len((text or "").encode()) + 1 and r["text_crc32"] == crc(text) and r["law"] == "rows" and r["grown_shard"] is None
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert set(shards) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1


def test_op9_measures_every_text(documents, answer):
    _, rows = answer("op9_quality_rules")
    assert len(rows) == len(documents)
    for r in rows:
        text = documents[r["doc_id"]]["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen, repeated = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                repeated += line in seen
                seen.add(line)
        windows = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(inside))
        assert r["base_failed"] == (len(words) < 50 or 100 * len(inside) > 50 * len(words)) and not (r["base_failed"] and r["kept"])


def test_op10_texts_have_their_checksum(documents, answer):
    types, rows = answer("op10_line_dedup")
    assert types == {"doc_id": "bigint", "text": "string", "text_crc32": "bigint"} and len(rows) == len(documents)
    assert all(r["text_crc32"] == crc(r["text"]) and len(r["text"] or "") <= len(documents[r["doc_id"]]["text"] or "") for r in rows if r["text"] is not None)
