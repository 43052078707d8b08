import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from cellframe.llm import near_dedup, substring_dedup
from cellframe.llm.bpe import Encoded, concatenate, decode_documents, encode_documents
from cellframe.llm.bpe_words import WordEncoder
from cellframe.llm.html_text import extract_text, main_text
from cellframe.llm.language import has_letter, identify
from cellframe.llm.line_dedup import drop_repeated_lines
from cellframe.llm.near_dedup import BANDS, ROWS, near_duplicates
from cellframe.llm.packing import TightestFit, best_fit_decreasing, pack_documents
from cellframe.llm.quality import kth_largest, quality_scores, select_documents
from cellframe.llm.shingles import Minima, shingle_set, signature_bytes
from cellframe.llm.stars import components
from cellframe.llm.substring_dedup import drop_repeated_passages

FILE = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(FILE)
# Columns with names that operators use themselves.
CLASH = "n_lines int, kept_text string, ids string, label string, slice int, n_words int, log_weight string, core string"


@pytest.fixture(scope="module")
def corpus(spark):
    """Copies, near copies, shared passages and lines, odd and very long texts; unique ids, plus clashes."""
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("abcdefgh", k=draw.randint(2, 5)))
    prose = lambda n: " ".join(word() + draw.choice(["", "", ".", ",", "\n"]) for _ in range(n))
    passage, line, base = prose(60), "A Line That many documents share", prose(150)
    texts = [None, "", "   ", "\n\n", "x", "One two three", "a a a " * 30, prose(5000), "é ü 中文 \U0001f600 ’quoted’ <|endoftext|> it's",
             line, f" {line.upper()}\t", prose(40) + "\n" + line, "z" * 3000]
    texts += [base] * 12 + [prose(draw.randint(20, 60)) for _ in range(20)]
    for _ in range(25):
        words = base.split(" ")
        for _ in range(draw.randint(1, 9)):
            words[draw.randrange(len(words))] = word()
        texts.append(" ".join(words))
    texts += [f"{prose(30)} {passage} {prose(30)}" for _ in range(10)] + [passage + " " + passage]
    texts += [f"{prose(5)}\n{line}\n{prose(5)}\n{line}" for _ in range(5)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for field in CLASH.split(", "):
        name, kind = field.split(" ")
        df = df.withColumn(name, F.lit(7).cast(kind))
    return rows, df.repartition(5)


def empty(df):
    return df.limit(0)


def odd_rows(df):
    """Rows without id and every row twice."""
    return df.unionByName(df).unionByName(df.where("doc_id in (20, 55)").withColumn("doc_id", F.lit(None).cast("long")))


def test_line_dedup(corpus):
    rows, df = corpus
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in drop_repeated_lines(df).collect()}
    assert got == brute.line_dedup(rows)
    assert "slice" in drop_repeated_lines(df).columns
    assert drop_repeated_lines(empty(df)).count() == 0


def test_line_dedup_of_repeated_rows_and_rows_without_id(corpus):
    rows, df = corpus
    want, got = brute.line_dedup(rows), drop_repeated_lines(odd_rows(df)).collect()
    assert len(got) == 2 * len(rows) + 2
    assert all((r.n_lines, r.n_dropped, r.kept_text) == want[r.doc_id] for r in got if r.doc_id is not None)
    assert all(r.n_dropped == 0 for r in got if r.doc_id is None)


def test_line_dedup_runs_no_python(corpus):
    plan = drop_repeated_lines(corpus[1])._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow")) and "rangepartitioning" in plan


def test_near_dedup(corpus):
    rows, df = corpus
    for words in (4, 5):
        got = near_duplicates(df, words=words).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_dedup(rows, words)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert near_duplicates(empty(df)).count() == 0


def test_near_dedup_of_odd_rows_and_small_blocks(corpus, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    rows, df = corpus
    want, got = brute.near_dedup(rows, 5), near_duplicates(odd_rows(df)).collect()
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got if r.doc_id is not None)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)


def test_links_that_only_a_third_member_shows(spark):
    """A chain: each text is linked with the next one only, so the smallest member of a bucket is no help."""
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[12 * k:12 * k + 130])) for k in range(20)]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: c for d, (_, c) in brute.near_dedup(rows, 5).items()}


@pytest.mark.parametrize("n_words", [120, 1500, 3000])
def test_links_beside_many_members_just_below_the_similarity(spark, n_words):
    """Twelve pairs at 0.83, each among 60 texts at 0.75 with smaller ids that share their buckets."""
    draw = random.Random(n_words)
    fresh = iter(range(10 ** 9))

    def changed(words, similarity):
        """One word in five lost shingles: (n - 5c) / (n + 5c) are common after c changes far apart."""
        out, c = list(words), round(n_words * (1 - similarity) / (1 + similarity) / 5)
        for k in draw.sample(range(2, n_words // 5 - 2), c):
            out[5 * k] = f"new{next(fresh)}"
        return out

    rows = []
    for group in range(12):
        base = [f"w{draw.randrange(10 ** 7)}" for _ in range(n_words)]
        rows += [(1000 * group + k, " ".join(changed(base, 0.745))) for k in range(60)]
        rows += [(1000 * group + 990, " ".join(base)), (1000 * group + 991, " ".join(changed(base, 0.83)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near_duplicates(df).collect()}
    assert [got[1000 * g + 991] for g in range(12)] == [1000 * g + 990 for g in range(12)]
    assert all(d == c for d, c in got.items() if d % 1000 != 991)


@pytest.mark.parametrize("n_words", [100, 1000, 20000])
def test_signatures_of_unrelated_texts_differ(n_words):
    minima = Minima(BANDS * ROWS)
    one, two = (np.frombuffer(signature_bytes(minima.of(shingle_set(
        " ".join(f"{side}{k}" for k in range(n_words)).encode(), 5))), np.uint8) for side in "ab")
    assert (one == two).mean() < 0.05


def test_near_dedup_of_very_long_texts(spark):
    draw = random.Random(8)
    base = [f"w{draw.randrange(10 ** 6)}" for _ in range(20000)]
    rows = [(k, " ".join(base[100 * k:20000 - 150 * k])) for k in range(12)]
    rows += [(100 + k, " ".join(f"x{draw.randrange(10 ** 6)}" for _ in range(20000))) for k in range(4)]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: c for d, (_, c) in brute.near_dedup(rows, 5).items()}


def test_components(spark):
    draw = random.Random(2)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [
        (draw.randint(200, 400), draw.randint(200, 400)) for _ in range(120)] + [(7, 7)]
    up = {}
    for a, b in edges:
        up.setdefault(a, a), up.setdefault(b, b)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in {x for e in edges for x in e if e[0] != e[1]}}


@pytest.mark.parametrize("tree", [1000, 2])
def test_substring_dedup(corpus, monkeypatch, tree):
    monkeypatch.setattr(substring_dedup, "TREE", tree)
    rows, df = corpus
    want = brute.removed_words(rows)
    got = drop_repeated_passages(df, joined=True).collect()
    assert len(got) == len(rows)
    for r in got:
        words, stays = want[r.doc_id]
        assert (r.n_words, r.n_removed) == (len(words), stays.count(False)), r.doc_id
        assert r.kept_text == " ".join(w for w, s in zip(words, stays) if s)


def test_substring_dedup_gives_the_same_result_each_time(spark, corpus, monkeypatch):
    """On cached input, whose partitions Spark may reorder, and with cores cut over trees and ranges."""
    monkeypatch.setattr(substring_dedup, "TREE", 5)
    rows, df = corpus
    kept, want = df.cache(), brute.removed_words(rows)
    for _ in range(12):
        got = {r.doc_id: r.n_removed for r in drop_repeated_passages(kept).collect()}
        assert got == {d: stays.count(False) for d, (_, stays) in want.items()}
    kept.unpersist()


def test_substring_dedup_spreads_a_passage_that_most_texts_hold(spark):
    """Its cores are bounds of several ranges, and the copies meet again."""
    passage = [f"p{k}" for k in range(24)]
    rows = [(d, " ".join([f"a{d}"] * (d % 3) + passage + [f"b{d}x{k}" for k in range(d % 25)])) for d in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    known = df.select("doc_id", F.hash("text").alias("version"), "text")
    bounds = substring_dedup.range_bounds(known, 16)
    assert bounds == sorted(bounds) and len(set(bounds)) < len(bounds) == 15
    assert bounds == substring_dedup.range_bounds(known.repartition(3), 16)
    want = brute.removed_words(rows)
    got = {r.doc_id: r.n_removed for r in drop_repeated_passages(df).collect()}
    assert got == {d: stays.count(False) for d, (_, stays) in want.items()}


def test_substring_dedup_keeps_the_text_between(corpus):
    rows, df = corpus
    texts, want = dict(rows), brute.removed_words(rows)
    for r in drop_repeated_passages(odd_rows(df)).collect():
        if r.doc_id is None:
            assert r.n_removed == 0
            continue
        words, stays = want[r.doc_id]
        assert brute.WORD.findall(r.kept_text) == [w for w, s in zip(words, stays) if s]
        assert r.n_removed or r.kept_text == (texts[r.doc_id] or "")
    assert drop_repeated_passages(empty(df)).count() == 0


def test_packing(corpus):
    rows, df = corpus
    encode = WordEncoder(FILE).ids
    for frame, times in ((df, 1), (odd_rows(df), 2)):
        got = [r for r in pack_documents(frame, FILE, window=256).collect()]
        for d, text in rows:
            ids = encode((text or "").encode()) + b"\x01\0\0\0"
            mine = sorted((r.start, r.length, r.ids_crc32) for r in got if r.doc_id == d)
            assert len(mine) % times == 0
            at = 0
            for start, length, crc in mine[::times]:
                assert start == at and crc == zlib.crc32(ids[4 * start:4 * (start + length)])
                at += length
            assert at == len(ids) // 4
        sequences = {}
        for r in sorted(got, key=lambda r: r.offset):
            assert r.offset == sequences.get(r.sequence_id, 0)
            sequences[r.sequence_id] = r.offset + r.length
        assert max(sequences.values()) <= 256
    assert pack_documents(empty(df), FILE).count() == 0


def test_best_fit_decreasing_takes_the_tightest_window():
    draw = random.Random(1)
    for window in (1, 2, 7, 64, 100):
        lengths = [draw.randint(1, window) for _ in range(draw.randint(0, 200))]
        placed, room, want = best_fit_decreasing(lengths, window), [], {}
        for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
            fits = [c for c in room if c >= lengths[k]]
            want[k] = min(fits) if fits else window
            if fits:
                room.remove(min(fits))
            room.append(want[k] - lengths[k])
        assert [window - offset for _, offset in placed] == [want[k] for k in range(len(lengths))]
    assert TightestFit(8).take(3) is None


def test_bpe_round_trip(corpus):
    rows, df = corpus
    for frame, options in ((df, {}), (odd_rows(df), {"long": 300, "piece": 70})):
        got = encode_documents(frame, FILE, decoded=True, **options).collect()
        again = decode_documents(encode_documents(frame, FILE, **options), FILE)
        assert sorted(r.decoded for r in again.collect()) == sorted(r.decoded for r in got)
        assert len(got) == frame.count()
        texts = dict(rows)
        for r in got:
            if r.doc_id is not None:
                ids = LIBRARY.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
                assert np.frombuffer(r.ids, "<u4").tolist() == ids
                assert r.decoded == LIBRARY.decode(ids, skip_special_tokens=False)
    assert encode_documents(empty(df), FILE).count() == 0


def test_tree_concatenation_of_awkward_texts():
    draw = random.Random(3)
    letters = list("abcdefghilmnorstuz") + ["'s", "'", "'ll", "1", "!", "...", "aaaa", "é", "́", "中", "😀", " ", "\n", "<|endoftext|>", "<|"]
    for _ in range(300):
        text = "".join(draw.choices(draw.choice([letters, letters[:18], ["a"], ["'", "s"], ["!", "'", "s", "l"]]), k=draw.randint(20, 200)))
        cut = draw.randint(1, len(text) - 1)
        both = concatenate(LIBRARY, Encoded.of(LIBRARY, text[:cut]), Encoded.of(LIBRARY, text[cut:]), window=8)
        assert both.ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_word_encoder_equals_the_library():
    draw, encode = random.Random(5), WordEncoder(FILE).ids
    letters = list("abzAZ019_'\"!?-. \t\n\x0b\x0c\r\x00\x7f\xa0\xaa\xd7\xf7éÉßİıĀǅ²½\x85\x1c’“–€́ 　中") + ["'s", "<|endoftext|>"]
    for _ in range(2000):
        text = "".join(draw.choices(letters, k=draw.randint(1, 14)))
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_language(spark, corpus):
    rows, df = corpus
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify(docs).join(docs.select("doc_id", F.col("lang")), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    odd = identify(odd_rows(df).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").when(F.col("doc_id") % 3 == 0, "bb"))).collect()
    texts = dict(rows)
    assert len(odd) == 2 * len(rows) + 2
    for r in odd:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            assert (r.lang_pred == "und") == (not has_letter(texts[r.doc_id]))
            assert r.lang_pred in ("aa", "bb", "und") and 0 <= r.score <= 1
    assert identify(empty(df).withColumn("lang", F.lit("x"))).count() == 0
    assert {r.lang_pred for r in identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_quality(spark, corpus):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality_scores(docs, labels)
    got = {r.doc_id: r.kept for r in scored.collect()}
    told = {r.doc_id: r.quality == 1 and r.toxic == 0 for r in labels.collect()}
    assert sum(got[d] == good for d, good in told.items()) >= 0.85 * len(told)  # a few hundred labels
    kept = select_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {d for d, k in got.items() if k}
    _, df = corpus
    odd = odd_rows(df)
    assert quality_scores(odd, labels).count() == odd.count()
    assert quality_scores(df, empty(labels)).count() == df.count()
    assert quality_scores(empty(df), labels).count() == 0 and select_documents(empty(df), labels).count() == 0


def test_kth_largest(spark):
    values = [5, 5, 5, -3, 1 << 40, -(1 << 40), 0, 7, 7, 123456789]
    df = spark.createDataFrame([(v,) for v in values], "key long")
    for k in range(1, len(values) + 1):
        assert kth_largest(df, k) == sorted(values, reverse=True)[k - 1]


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies, a lot.</div>
<div id="wrap"><div class="ad">Buy now, buy more, buy it all today.</div><div class="content"><h1>The title</h1>
<p>First &amp; foremost,  some   text that is long enough, with commas, to count.<br>And more
<p><b>Bold</b> words &mdash; and a <a href="x">link</a>, in a paragraph without an end
<ul><li>One thing, in a list</li><li>Two</li></ul><form><p>Name, please, and address, and all else</p></form>
<blockquote>Quoted.</blockquote><p>5 &lt; 6</p></div><div class="sidebar"><p>Related, popular, and more, a long paragraph of links.</p></div>
<div class="comments"><p>I disagree, strongly, with all of this, says a reader of some standing.</p></div></div>
<footer>&copy; me</footer></body></html>"""


def test_html_text(spark):
    want = ("The title\nFirst & foremost, some text that is long enough, with commas, to count. And more\n"
            "Bold words — and a link, in a paragraph without an end\nOne thing, in a list\nTwo\nQuoted.\n5 < 6")
    assert main_text(PAGE) == want
    odd = [PAGE, None, "", "plain", "<", "<p", "<p>cut &am", "<div>" * 3000 + "deep, very deep, text" + "</p></x>", "<!-- x", "<script>never ends"]
    df = spark.createDataFrame([(k, f"u{k}", h, "t") for k, h in enumerate(odd)], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in extract_text(df).collect()}
    assert len(got) == len(odd) and got[0].text == want and got[0].n_chars == len(want)
    assert got[1].text == got[2].text == got[8].text == got[9].text == "" and got[6].text == "cut &am"
    assert got[7].text == "deep, very deep, text" and got[3].text == "plain"
    assert extract_text(df.limit(0)).count() == 0


def test_html_text_of_the_given_pages(spark):
    import re
    from html import unescape

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in extract_text(pages).collect():
        inner = re.search(r"<article>(.*?)</article>", html[r.page_id], re.S)[1]
        blocks = (" ".join(unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n".join(b for b in blocks if b)
