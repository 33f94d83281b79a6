"""Every operator against brute force, round trips or SQL, with nulls, empty and long texts, ties and repeated rows."""

import collections
import hashlib
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
from siteweave.llm import bpe, html_text, line_dedup, media, mixing, near_dedup, quality, rules, suffix_dedup, warc  # noqa: E402

DOCS = "doc_id long, text string, source string, lang string, n_chars long"


def documents(spark, texts, source=lambda k: f"s{k % 3}"):
    rows = [(k, t, source(k), "en", None if t is None else len(t)) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("aeinorst", k=draw.randint(1, 7))) for _ in range(n))


def mixed_texts():
    base = prose(1, 300)
    near = base.split()
    near[100] = "changed"
    return [base, base, " ".join(near), None, "", "one", "two words", prose(2, 4000), base + "\n" + prose(3, 50), "Ää ß 漢字 " * 60, "x" * 5000, prose(4, 60), prose(5, 200), " \t\n "]


# --- line dedup


def brute_lines(texts, min_docs, keep_first=False):
    white = " \t\n\x0b\x0c\r"
    key = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s.strip(white))
    lines = [(t or "").split("\n") for t in texts]
    seen = collections.Counter(k for ls in lines for k in {key(s) for s in ls} if k)
    out, first = [], set()
    for ls in lines:
        kept = []
        for s in ls:
            if seen[key(s)] < min_docs or keep_first and key(s) not in first:
                kept.append(s)
            first.add(key(s))
        out.append("\n".join(kept))
    return out


@pytest.mark.parametrize("keep_first", [False, True])
def test_lines(spark, keep_first):
    draw = random.Random(8)
    pool = ["Same line", "  same LINE\t", "other", "", "Ünï", "rare 1", "rare 2"]
    texts = ["\n".join(draw.choices(pool, k=draw.randint(1, 90))) for _ in range(30)] + [None, "", "\n", "lonely"]
    docs = documents(spark, texts)
    for least in (3, 20):
        got = {r.doc_id: (r["__lines"], r["__dropped"], r["__kept"]) for r in line_dedup.mark_lines(docs, least, keep_first=keep_first).collect()}
        for k, want in enumerate(brute_lines(texts, least, keep_first)):
            whole = (texts[k] or "").split("\n")
            assert got[k][0] == len(whole) and got[k][2] == want, k


def test_lines_of_repeated_rows(spark):
    rows = [(1, "a\nb", None, None, None)] * 3 + [(None, "a", None, None, None)]
    odd = spark.createDataFrame([(1, "a\nb", 5, 6, 7)] * 3 + [(2, "a", 5, 6, 7)], "doc_id long, text string, `__row` int, `a.b` int, doc int")
    held = line_dedup.dedup_lines(odd, min_docs=4)
    assert held.columns == odd.columns and sorted(tuple(r) for r in held.collect()) == [(1, "b", 5, 6, 7)] * 3 + [(2, "", 5, 6, 7)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS), min_docs=4).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, ""), (1, "b"), (1, "b"), (1, "b")]
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0


# --- mixing


def test_mix_comes_near_targets(spark):
    docs = documents(spark, [prose(k, 5 + k % 90) for k in range(600)] + [None, ""], lambda k: None if k % 50 == 0 else f"s{0 if k % 3 else k % 7}")
    rows = mixing.mix(docs.select("doc_id", "text", "source")).collect()
    assert len(rows) == 602 and all(r["__copies"] in (0, 1, 2) for r in rows)
    taken, target, size = collections.Counter(), {}, collections.Counter()
    for r in rows:
        taken[r.source] += r["__copies"] * r["__size"]
        size[r.source] += r["__size"]
        target[r.source] = r["__target"]
        assert size[r.source] <= r["__source_size"]
    for s, t in target.items():
        assert t <= 2 * size[s] + 1e-6 and abs(taken[s] - t) <= 100 + 0.02 * t
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    again = mixing.mix(docs.select("doc_id", "text", "source").repartition(5)).collect()
    assert sorted((r.doc_id, r["__copies"]) for r in rows) == sorted((r.doc_id, r["__copies"]) for r in again)


def test_mix_strata_and_take(spark):
    docs = documents(spark, [prose(k, 20) for k in range(100)])
    out = mixing.take(docs, stratum_rows=7)
    assert out.columns == docs.columns and 100 <= out.count() <= 200
    assert mixing.take(documents(spark, [])).count() == 0
    assert mixing.take(documents(spark, [None, "", " "])).count() == 0


def test_mix_shuffles_documents_once(spark, monkeypatch):
    """Joining the few sources and strata shuffled whole documents twice before the window did."""
    docs = documents(spark, [prose(k, 20) for k in range(100)], lambda k: None if k % 10 == 0 else f"s{k % 3}")
    out = mixing.take(docs, stratum_rows=7)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2
    found = sorted(r.doc_id for r in out.collect())
    monkeypatch.setattr(mixing, "BROADCAST", 0)
    assert sorted(r.doc_id for r in mixing.take(docs, stratum_rows=7).collect()) == found


# --- byte-level BPE

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_bpe_is_tiktoken(spark):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(2)
    texts = mixed_texts() + ["".join(draw.choices("ab 's\t\n\r\x1c\x85\xa0 　ÀÉ漢字١½😀<|endoftext|>'ll", k=draw.randint(0, 40))) for _ in range(300)]
    docs = documents(spark, texts)
    ids = bpe.encode_column(F.col("text"), RANKS, public_tokenizers.PATTERN)
    got = docs.select("doc_id", ids.alias("ids")).withColumn("back", bpe.decode_column(F.col("ids"), RANKS, public_tokenizers.PATTERN)).orderBy("doc_id").collect()
    for r, t in zip(got, texts, strict=True):
        assert r.ids == own.encode_ordinary(t or "") and bytes(r.back) == (t or "").encode()
    row = docs.where("doc_id = 0").select(bpe.digest_column(F.col("text"), RANKS, public_tokenizers.PATTERN).alias("d")).first().d
    assert row.n_tokens == len(got[0].ids) and row.ids_sha256 == hashlib.sha256(",".join(map(str, got[0].ids)).encode()).hexdigest()


def test_bpe_hands_back_what_it_remembered():
    """In a process of its own, as a worker is one: what was remembered stayed with the process when it was forgotten."""
    code = f"""
import ctypes, random, re
import public_tokenizers
from siteweave.llm import bpe
private = lambda: sum(map(int, re.findall(r"Pss_Anon: +([0-9]+)", open("/proc/self/smaps_rollup").read()))) / 1024
draw, own = random.Random(1), bpe.codec({RANKS!r}, public_tokenizers.PATTERN)
for ids in own.encode_all(" ".join("".join(draw.choices("abcdefgh", k=9)) for _ in range(40)) for _ in range(2500)):
    pass
own.forget()
after = private()
ctypes.CDLL(None).malloc_trim(0)
print(after - private())
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[2], capture_output=True, text=True, check=True).stdout
    assert float(out) < 4


# --- media


def test_media_round_trip(spark):
    texts = mixed_texts()
    got = documents(spark, texts).select("doc_id", media.digest_column(F.col("text")).alias("d"), media.media_column(F.col("text")).alias("m")).orderBy("doc_id").collect()
    for r, t in zip(got, texts, strict=True):
        raw = (t or "").encode()
        padded = raw + b" " * (192 * max(1, -(-len(raw) // 192)) - len(raw))
        assert r.d.n_bytes == len(raw) and r.d.payload_sha256 == hashlib.sha256(padded).hexdigest() and bytes(r.m.payload) == padded
        assert r.d.media_sha256 == hashlib.sha256(bytes(r.m.media)).hexdigest()
    assert got[0].d.feature == got[1].d.feature


def test_formats():
    draw = np.random.default_rng(3)
    rgb, grey = draw.integers(0, 256, (7, 5, 3), np.uint8), draw.integers(0, 256, (4, 9), np.uint8)
    for p in (rgb, grey):
        assert (media.decode(media.encode_netpbm(p)) == p).all()
    assert (media.decode(media.encode_bmp(rgb)) == rgb).all()
    assert media.decode(b"P1\n# c\n3 2\n1 0 1\n0 1 0\n").tolist() == [[0, 255, 0], [255, 0, 255]]
    assert media.decode(b"P2 2 1 15 0 15\n").tolist() == [[0, 255]]
    assert media.decode(b"P4\n3 1\n\xa0").tolist() == [[0, 255, 0]]
    for bad in (b"P6\n2 2\n255\nabc", b"GIF89a", b"BM", b"P5\n1 1\n65535\n\0\0"):
        with pytest.raises(ValueError):
            media.decode(bad)


def test_area_resize():
    p = np.arange(48, dtype=np.uint8).reshape(6, 8)
    assert np.allclose(media.area_resize(p, 3, 4), p.reshape(3, 2, 4, 2).mean((1, 3)))
    assert np.isclose(media.area_resize(p, 5, 3).mean(), p.mean())
    assert media.npy_tile(p)[:6] == b"\x93NUMPY" and len(media.difference_hash(p)) == 16


# --- rules and classifier


def labelled(spark, n=400):
    draw = random.Random(6)
    texts, labels = [], []
    for k in range(n):
        good = k % 3 > 0
        text = prose(k, draw.randint(60, 120))
        texts.append(text if good else " ".join(w + draw.choice(["###", "$$$", "&&&"]) for w in text.split()))
        labels.append((k, int(good), 0))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_statistics():
    def brute(text):
        words = (text or "").encode().split()
        grams = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
        return len(words), len(covered)

    for text in [*mixed_texts(), "a b c a b c", "a a a a", "a b c d a b c x a b c", "x y\n\nx y\n \n x y", "A#b*c|"]:
        got = dict(zip(rules.STATISTICS, rules.text_statistics(text), strict=True))
        assert (got["n_words"], got["n_repeat_words"]) == brute(text)
    got = dict(zip(rules.STATISTICS, rules.text_statistics("x y\n\nx y\n \n x y\n"), strict=True))
    assert got["n_dup_lines"] == 1 and got["word_chars"] == 6


def test_rules(spark):
    docs, labels = labelled(spark)
    learned = rules.fit(docs, labels)
    assert learned.rules
    got = {r.doc_id: r["__kept"] for r in rules.judge(docs, learned).collect()}
    assert sum(got[r.doc_id] == bool(r.quality) for r in labels.collect()) >= 0.98 * len(got)
    kept = rules.keep_good(documents(spark, mixed_texts()), rules.DecisionList())
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {0, 1, 2, 7, 8, 9, 11, 12} - {9}
    assert rules.fit(docs, labels.limit(0)).sql() == "true"
    assert rules.fit(docs, labels.selectExpr("doc_id", "1 AS quality", "toxic")).sql() == "true"


def test_classifier(spark):
    docs, labels = labelled(spark)
    model = quality.fit(docs, labels)
    got = {r.doc_id: r for r in quality.score(docs, model).withColumn("h", quality.held_out(F.col("doc_id"))).collect()}
    held = [(got[r.doc_id]["__score"], r.quality) for r in labels.collect() if got[r.doc_id].h]
    assert len(held) > 40 and np.mean([(s >= 0.3) == bool(q) for s, q in held]) >= 0.95
    scores = [r["__score"] for r in quality.score(documents(spark, mixed_texts()), model).collect()]
    assert all(0 <= s <= 1 for s in scores)
    only = quality.fit(docs, labels.where("quality = 1"))
    assert {r["__score"] for r in quality.score(docs.limit(3), only).collect()} == {1.0}
    # the held-out fold's labels are never seen
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r["__score"] for r in quality.score(docs, quality.fit(docs, flipped)).collect()}
    assert all(again[k] == got[k]["__score"] for k in again)


# --- suffix-array dedup


def brute_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        out.append((bytes(np.frombuffer(b, np.uint8)[~gone]), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(np.int8)]) == 1).sum())))
    return out


@pytest.mark.parametrize("local_spans", [4096, 1])
def test_suffixes(spark, local_spans):
    draw = random.Random(12)
    shared = prose(20, 90)
    texts = [*mixed_texts(), *(prose(k, 30) + " " + shared[draw.randint(0, 60) : draw.randint(250, 480)] + prose(k + 50, 20) for k in range(25)), "é" * 300, "z" + "é" * 300, shared, shared + "!"]
    docs = documents(spark, texts)
    out = suffix_dedup.with_repeats(docs, local_spans=local_spans)
    got = {r.doc_id: r for r in out.select("doc_id", suffix_dedup.kept_column(F.col("text"), F.col("__intervals"), F.col("__windows")).alias("kept"), suffix_dedup.digest_column(F.col("text"), F.col("__intervals"), F.col("__windows")).alias("d")).collect()}
    for k, (kept, gone, runs) in enumerate(brute_repeats(texts, 200)):
        assert (bytes(got[k].kept), got[k].d.n_removed, got[k].d.n_spans) == (kept, gone, runs), k
    assert suffix_dedup.with_repeats(documents(spark, [])).count() == 0


def test_merge_never_disagrees_with_sort():
    draw = random.Random(1)
    runs = [sorted(bytes(draw.choices(b"ab", k=draw.randint(0, 40))) for _ in range(draw.randint(0, 30))) for _ in range(5)]
    packed = [suffix_dedup.pack_run([(t, 0, False, k, i) for i, t in enumerate(run)]) for k, run in enumerate(runs)]
    merged = list(suffix_dedup.merge_runs([suffix_dedup.unpack_run(p) for p in packed]))
    assert [t for _, t, _ in merged] == sorted(t for run in runs for t in run)
    last = b""
    for common, t, _ in merged:
        assert common == suffix_dedup.common_prefix(t, last, 0)
        last = t
    assert list(suffix_dedup.merge_runs([])) == []


def test_long_documents_are_cut_without_loss(monkeypatch):
    text = np.frombuffer(prose(3, 3000).encode(), np.uint8)
    whole = suffix_dedup.spans_of(text)
    monkeypatch.setattr(suffix_dedup, "BUFFER", 1000)
    (_, _, _, _, pieces), = suffix_dedup._documents(iter([(1, text.tobytes())]), 200, 64)
    windows = lambda s: [(w, m) for f, l, m in zip(*s[:3], strict=True) for w in range(f, l + 1)]  # noqa: E731, E741
    assert windows(pieces) == windows(whole)


def test_long_documents_between_short_ones(spark, monkeypatch):
    shared = prose(21, 90)[:300]
    short = [prose(k, 30) + shared for k in range(60, 72)]
    long = [shared + prose(k, 600_000) for k in (80, 81)]
    assert min(map(len, long)) > suffix_dedup.BUFFER
    out = suffix_dedup.with_repeats(documents(spark, [*short[:6], long[0], *short[6:], long[1]]))
    got = out.select(suffix_dedup.digest_column(F.col("text"), F.col("__intervals"), F.col("__windows")).alias("d")).collect()
    assert [(r.d.n_removed >= 300, r.d.n_spans) for r in got] == [(True, 1)] * 14

    texts = [short[0], long[0][:9000], short[1], short[2], long[1][:9000], short[3]]
    spans = [next(iter(suffix_dedup._documents(iter([(k, t.encode())]), 200, 64)))[4][0] for k, t in enumerate(texts)]
    picked = lambda: iter([suffix_dedup.pd.DataFrame({"row": range(6), "text": texts, "picks": [[np.arange(len(s), dtype="<u4").tobytes()] for s in spans]})])
    whole = sorted(suffix_dedup._selected(picked(), 200, 64))
    monkeypatch.setattr(suffix_dedup, "BUFFER", 9000 - 1)
    assert sorted(suffix_dedup._selected(picked(), 200, 64)) == whole


# --- WARC


def test_warc_round_trip(spark):
    page = "<p>" + prose(1, 60) + "\r\n\r\nWARC/1.1\r\n"
    rows = [(5, "http://a", page), (3, "http://b\r\nx: y", page), (9, None, page), (4, "u", "short"), (6, "u", "short"), (7, "u", None), (None, "u", page), (8, "u", "Ä" * 90), (3, "http://b", page)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.record_id or "null", r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.payload and bytes(r.payload)) for r in warc.round_trip(pages).collect())
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = h == page and i != 3
        want.append((str(i) if i is not None else "null", "revisit" if again else "response", "3" if again else None, len(raw), hashlib.sha256(raw).hexdigest(), None if again else raw))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_ids_and_files(spark, tmp_path):
    ids = ["null", "", "a>b\r\nc", "ü %20", None]
    pages = spark.createDataFrame([(i, "u", "x" * 200 + str(k % 2), k) for k, i in enumerate(ids)], "page_id string, url string, html string, `__digest` int")
    want = sorted(("" if i is None else "=" + i) for i in ids)
    archives = warc.write_archives(pages)
    assert warc.write_files(archives, str(tmp_path / "w")) == 1
    rows = warc.read_files(spark, str(tmp_path / "w")).collect()
    assert sorted("" if r.record_id is None else "=" + r.record_id for r in rows) == want
    import gzip

    assert gzip.open(tmp_path / "w" / "part-00000.warc.gz").read().startswith(b"WARC/1.1")


def test_warc_reader_is_strict():
    whole = warc.write_record("1", "u", b"abc" * 50) + warc.write_record("2", None, b"")
    for piece in (1, 7, 100_000):
        found = list(warc.read_records(whole[i : i + piece] for i in range(0, len(whole), piece)))
        assert [r.http()[1] for r in found] == [b"abc" * 50, b""]
    import gzip

    member = gzip.decompress(warc.write_record("1", "u", b"abc" * 50))
    bad = [whole[:-3], b"junk", gzip.compress(member.replace(b"abcabc", b"abdabc", 1)), gzip.compress(member + b"x"), gzip.compress(member[:-6]), gzip.compress(b"no record\r\n\r\n")]
    for data in bad:
        with pytest.raises(warc.WarcError):
            list(warc.read_records([data]))


# --- HTML


def test_main_text():
    page = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no";</script></head><body><header><h1>Site</h1></header><nav><a href=1>Home</a></nav>
<div class="cookie-notice">We use cookies for many good reasons that nobody reads until the end.</div><div class="sidebar"><p>Something else that is quite long and has a lot of words in it, really.</p></div>
<main><article><h1>Title &amp; more</h1><p>Short.</p><p>A <a href="x>y">link</a>&nbsp;in\n  text</p><!-- <p>no</p> --><div class="ad">Buy this</div><ul><li>one</li><li>two &lt;3</ul><form>Sign <b>up</b></form></article>
<section id="comments"><p>I liked this article very much, it was long and had many words in it.</p></section></main><footer>&copy; all of us</footer></body></html>"""
    assert html_text.main_text(page) == "Title & more\n\nShort.\n\nA link in text\n\none\n\ntwo <3"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<script>x") == ""
    assert html_text.main_text("<article><p>cut off <b>here") == "cut off here"
    long = prose(1, 50_000)
    assert html_text.main_text(f"<article><p>{long}</p></article>") == long
    assert html_text.main_text("<div><p>" + prose(2, 40) + "</p><p>" + prose(3, 40) + "</p></div>").count("\n\n") == 1
    table = np.array(html_text.LABELLED, float)
    assert (html_text.tree().predict(table[:, :-1]) == (table[:, -1] > 0)).all()


def test_main_text_column(spark):
    df = spark.createDataFrame([("<main><p>a b</p></main>",), (None,)], "html string")
    assert [r.t for r in df.select(html_text.main_text_column(F.col("html")).alias("t")).collect()] == ["a b", ""]


PARAGRAPH = "word " * 79 + "end."
MENU = "<nav><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul></nav>"
FOOT = "<footer><p>Copyright 2020 Someone. All rights.</p></footer>"
#: Pages made by hand, none of them in the labelled table, and their main text.
PAGES = [
    (f'{MENU}<main class="content with-sidebar"><h1>A title here</h1><p>{PARAGRAPH}</p><p>Short.</p></main>{FOOT}', f"A title here\n\n{PARAGRAPH}\n\nShort."),
    (f'{MENU}<div id="main" class="two-column no-sidebar"><h1>T</h1><p>{PARAGRAPH}</p></div>{FOOT}', f"T\n\n{PARAGRAPH}"),
    (f'{MENU}<article class="post related-topics"><p>{PARAGRAPH}</p></article>{FOOT}', PARAGRAPH),
    (f'{MENU}<div class="response"><p>{PARAGRAPH}</p></div>{FOOT}', PARAGRAPH),
    (f"<form action=x>{MENU}<h1>A title</h1><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p>{FOOT}</form>", f"A title\n\n{PARAGRAPH}\n\n{PARAGRAPH}"),
    (f"<article><a title='a > b' href=x>link</a> <p title=it's>{PARAGRAPH}</p></article>", f"link\n\n{PARAGRAPH}"),
    (f'{MENU}<article><p>{PARAGRAPH}</p></article><section id="comments"><article class="comment-body"><p>{PARAGRAPH}{PARAGRAPH}</p></article></section>{FOOT}', PARAGRAPH),
    (f'<div class="page has-sidebar">{MENU}<article><p>{PARAGRAPH}</p></article><aside><p>{PARAGRAPH}</p></aside></div>', PARAGRAPH),
    (f"{MENU}<article><p>{PARAGRAPH}</p></article><form><p>Subscribe to our newsletter</p></form>{FOOT}", PARAGRAPH),
    (f'{MENU}<div class="ad">Buy this now</div><div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p><p>Well then.</p></div><div class="comments"><p>{PARAGRAPH}</p></div>{FOOT}', f"{PARAGRAPH}\n\n{PARAGRAPH}\n\nWell then."),
    (f'{MENU}<div class="cookie-notice"><p>We use cookies.</p></div><p>{PARAGRAPH}</p>', PARAGRAPH),
    (f'<article><p title="never closed>{PARAGRAPH}</p></article>', PARAGRAPH),
]


@pytest.mark.parametrize("k", range(len(PAGES)))
def test_pages_by_hand(k):
    page, want = PAGES[k]
    assert html_text.main_text(page) == want


def test_tree_reads_words_and_links():
    def used(node):
        return set() if node.feature < 0 else {html_text.FEATURES[node.feature]} | used(node.low) | used(node.high)

    assert used(html_text.tree()) >= {"link_density", "words_after", "density_before", "part_share"}
    listed = "".join(f"<li><a href=x{k}>Some other page</a></li>" for k in range(6))
    assert html_text.main_text(f"<ul>{listed}</ul><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p><ul>{listed}</ul>") == f"{PARAGRAPH}\n\n{PARAGRAPH}"


# --- near-dedup


def brute_components(texts, words, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [find(k) for k in range(len(sets))]


def near_texts():
    draw = random.Random(9)
    base = prose(30, 200).split()
    out = mixed_texts() + ["ONE", "one two three four five six seven", "One two three four five six seven eight"]
    for k in range(30):
        own = list(base)
        for _ in range(draw.randint(0, 14)):
            own[draw.randrange(len(own))] = f"w{k}{draw.randint(0, 99)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near(spark, words, percent):
    texts = near_texts()
    sizes, roots = brute_components(texts, words, percent)
    got = {r.doc_id: r for r in near_dedup.assign(documents(spark, texts), words, percent).collect()}
    assert [got[k].n_shingles for k in range(len(texts))] == sizes
    assert [got[k].component_id for k in range(len(texts))] == roots


def test_near_links_no_star_shows(spark):
    # one template, pages of each slot have own words there: linked in a slot, not between slots
    base = prose(116, 1000).split()
    texts = []
    for slot in range(21):
        for page in range(2):
            own = [f"w{slot}x{page}x{k}" for k in range(44)]
            at = slot * 47
            texts.append(" ".join(base[:at] + own + base[at + 44 :]))
    _, roots = brute_components(texts, 3, 85)
    assert len(set(roots)) == 21
    got = {r.doc_id: r.component_id for r in near_dedup.assign(documents(spark, texts), 3, 85).collect()}
    assert [got[k] for k in range(len(texts))] == roots


@pytest.mark.parametrize(("seed", "n", "words", "edits"), [(6, 160, 200, [4]), (3, 120, 200, [3, 4])])
def test_near_recall_is_whole(spark, seed, n, words, edits):
    # all texts meet in buckets, few are links: none may be lost
    draw = random.Random(seed)
    texts = []
    for k in range(n):
        own = [f"b{i}" for i in range(words)]
        for at in draw.sample(range(words), draw.choice(edits)):
            own[at] = f"n{k}_{at}"
        texts.append(" ".join(own))
    _, roots = brute_components(texts, 3, 85)
    assert 1 < len(set(roots)) < n
    got = {r.doc_id: r.component_id for r in near_dedup.assign(documents(spark, texts), 3, 85).collect()}
    assert [got[k] for k in range(n)] == roots


def test_near_keeps_one(spark):
    texts = near_texts()
    _, roots = brute_components(texts, 5, 80)
    docs = documents(spark, texts)
    again = [k for k in (0, 4, 12) if (texts[k] or "").split()]
    kept = near_dedup.keep_one(docs.unionByName(docs.where(F.col("doc_id").isin(again))))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(roots))
    ids = [(None, "a b c d e f"), (7, "a b c d e f"), (None, "g h i j k"), (None, "l m n o p"), (7, "q r s t u"), (7, "q r s t u"), (8, ""), (8, ""), (None, None)]
    odd = spark.createDataFrame([(i, t, 1, 2) for i, t in ids], "doc_id long, text string, row int, `__a.b` int")
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    rows = sorted(((r.doc_id or 0, r.text or "") for r in kept.collect()))
    assert rows == sorted([(7, "a b c d e f"), (0, "g h i j k"), (0, "l m n o p"), (7, "q r s t u"), (8, ""), (8, ""), (0, "")])
    assert near_dedup.assign(documents(spark, [])).count() == 0
    assert near_dedup.keep_one(documents(spark, [])).count() == 0


def test_densified_sketch():
    hashes = near_dedup.shingles("a b c d")
    full = near_dedup.sketch(hashes)
    assert set(full.tolist()) <= set(hashes.tolist()) and len(near_dedup.bands(hashes)) == near_dedup.BINS // near_dedup.BAND


def test_components(spark):
    draw = random.Random(3)
    links = [(k, k + 1) for k in range(0, 12)] + [(draw.randint(20, 60), draw.randint(20, 60)) for _ in range(25)] + [(70, 71), (71, 70)]
    root = {x: x for pair in links for x in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {k: v for k, v in got.items()} == {k: v for k, v in root.items() if k in got} and set(root) - set(got) <= {a for a, b in links if a == b}
