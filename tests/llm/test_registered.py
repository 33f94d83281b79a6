"""The registered queries that SQL can't express, over whole small tables, beside plain versions of their contracts."""

import hashlib
import html
import os
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from siteweave.llm import bpe, html_text, media, mixing, quality, queries, rules, suffix_dedup

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
needs_tables = pytest.mark.skipif(not os.path.exists(SF), reason="needs the driver's tables")


def texts(spark, name="documents", key="doc_id", text="text"):
    return {r[0]: r[1] or "" for r in spark.read.parquet(f"{SF}/{name}.parquet").select(key, text).collect()}


@needs_tables
def test_op1(spark):
    rows = {r.doc_id: r for r in queries.op1_quality(spark, SF).collect()}
    assert set(rows) == set(texts(spark))
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    # the same by numpy alone, from the model
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    for k, t in list(texts(spark).items())[:50]:
        x = (model.features(t) - model.center) / model.scale
        z = (np.tanh(x @ model.p["w1"] + model.p["b1"]) @ model.p["w2"] + model.p["b2"][0] + model.offset) / model.temperature
        assert abs(1 / (1 + np.exp(-np.clip(z, -30, 30))) - rows[k].score) < 1e-6


@needs_tables
def test_op2(spark):
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    ranks = load_tiktoken_bpe(public_tokenizers.path(queries.BPE_FILE))
    by = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = texts(spark)
    for r in queries.op2_byte_bpe(spark, SF).collect():
        ids = by.encode_ordinary(want[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()


@needs_tables
def test_op5(spark):
    want = texts(spark)
    for r in queries.op5_quality_rules(spark, SF).collect():
        text = want[r.doc_id]
        words = WORD.findall(text)
        places = defaultdict(list)
        for k in range(len(words) - 2):
            places[tuple(words[k : k + 3])].append(k)
        again = {k + j for found in places.values() if len(found) > 1 for k in found for j in range(3)}
        lines = text.split("\n")
        dup = sum(bool(WORD.search(line)) and line in lines[:k] for k, line in enumerate(lines))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again))
        assert r.base_failed == (len(words) < 50 or 100 * len(again) > 50 * len(words)) and (not r.base_failed or not r.kept)


@needs_tables
def test_op7(spark):
    raw = {k: t.encode() for k, t in texts(spark).items()}
    count = defaultdict(int)
    for t in raw.values():
        for i in range(len(t) - 199):
            count[hash(t[i : i + 200])] += 1
    for r in queries.op7_suffix_dedup(spark, SF).collect():
        t = raw[r.doc_id]
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if count[hash(t[i : i + 200])] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest())


@needs_tables
def test_op9(spark):
    pages = texts(spark, "pages", "page_id", "html")
    for r in queries.op9_html_text(spark, SF).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)
        parts = re.split(r"</?(?:p|h1|h2|ul|li)>", inner[1]) if inner else []
        parts = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>|<!--.*?-->", "", x))).split()) for x in parts]
        assert r.text == "\n\n".join(x for x in parts if x) and r.n_chars == len(r.text)


@needs_tables
def test_op10(spark):
    sets = {}
    for k, t in texts(spark).items():
        w = WORD.findall(t.translate({c: c + 32 for c in range(65, 91)}))
        sets[k] = {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for k, own in sets.items():
        for x in own:
            holders[x].append(k)
    for a, b in {(a, b) for held in holders.values() for a in held for b in held if a < b}:
        both = len(sets[a] & sets[b])
        if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    for r in queries.op10_near_dedup(spark, SF).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)


def test_any_names_and_empty_tables(spark):
    rows = [(1, "one two three " * 30, "s", 5, 6, 7), (1, "one two three " * 30, "s", 5, 6, 7), (None, None, None, None, None, None), (None, "x", "t", 1, 2, 3)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, source string, `__size` int, `a.b` int, doc int")
    how = (public_tokenizers.path(queries.BPE_FILE), public_tokenizers.PATTERN)
    for docs, n in ((odd, 4), (odd.limit(0), 0)):
        assert mixing.take(docs, total_share=2.0).columns == docs.columns
        mixed = mixing.mix(docs)
        assert mixed.count() == n and set(mixed.columns) == {*odd.columns, *mixing.ADDED}
        assert rules.keep_good(docs, rules.DecisionList()).columns == docs.columns
        assert quality.score(docs, quality.Model()).count() == n
        repeats = suffix_dedup.with_repeats(docs)
        assert repeats.count() == n and repeats.columns == [*odd.columns, "__intervals", "__windows"]
        for column in (bpe.digest_column(docs.text, *how), media.digest_column(docs.text), html_text.main_text_column(docs.text)):
            assert len(docs.select(column.alias("x")).collect()) == n
        coded = bpe.round_trip(docs, ["doc_id", "source"], *how).collect()
        assert len(coded) == n and all(r.round_trip and len(r.ids) == r.n_tokens for r in coded)
