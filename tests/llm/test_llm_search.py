"""Packing by a configuration program, hard negatives and ranked search, against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from brute import lower
from cellframe.llm import hard_negatives, ranked_search
from cellframe.llm.bpe_words import WordEncoder
from cellframe.llm.hard_negatives import bounds, hilbert_keys, mine_negatives, products
from cellframe.llm.lp_packing import Knapsack, configurations, pack_into_fewest, plan_windows
from cellframe.llm.packing import best_fit_decreasing
from cellframe.llm.ranked_search import Heaps, rank_documents, term_counts

FILE = public_tokenizers.path("word_bpe_49k.json")
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def histogram(lengths, window):
    return np.bincount(lengths, minlength=window + 1)


def checked(lengths, window):
    """The number of windows of a plan that holds exactly these lengths."""
    plan, held = plan_windows(histogram(lengths, window)), Counter()
    for copies, key in plan:
        assert sum(length * times for length, times in key) <= window
        for length, times in key:
            held[length] += copies * times
    assert held == Counter(lengths)
    return sum(copies for copies, _ in plan)


def test_plans_of_hard_histograms():
    draw = random.Random(1)
    triples = []
    for _ in range(3000):
        a, b = draw.randint(260, 400), draw.randint(260, 400)
        triples += [a, b, 1024 - a - b]
    windows = checked(triples, 1024)
    best_fit = max(s for s, _ in best_fit_decreasing(triples, 1024)) + 1
    assert windows <= 1.02 * 3000 < best_fit, "three pieces fill a window exactly, which best fit misses"
    assert checked([342] * 500, 1024) == 250 and checked([600] * 77, 1024) == 77 and checked([1], 1024) == 1
    prose = [1 + int(1023 * draw.random() ** 4) for _ in range(20000)]
    assert checked(prose, 1024) <= 1.002 * sum(prose) / 1024 + 1
    assert plan_windows(np.zeros(1025, np.int64)) == []
    assert sum(n for n, _ in plan_windows(histogram([3] * 10 ** 6 + [5] * 10 ** 6, 8))) == 10 ** 6


def test_knapsack_prices_the_best_content():
    draw = random.Random(2)
    for _ in range(30):
        window = draw.randint(2, 40)
        price = np.full(window + 1, -np.inf)
        for length in draw.sample(range(1, window + 1), draw.randint(1, min(6, window))):
            price[length] = draw.random()
        best = [0.0] * (window + 1)
        for c in range(1, window + 1):
            best[c] = max([best[c - 1]] + [best[c - k] + price[k] for k in range(1, c + 1)])
        knapsack = Knapsack(price)
        assert np.allclose(knapsack.value, best)
        content = knapsack.content(window, np.ones(window + 1))
        assert sum(content) <= window and math.isclose(sum(price[content]), best[window], abs_tol=1e-6)


def test_configurations_cover_the_histogram():
    draw = random.Random(3)
    number = histogram([draw.randint(1, 200) for _ in range(5000)], 256).astype(float)
    covered = np.zeros(257)
    copies = configurations(number, (0.25, 0.5, 0.75, 1.0))
    for key, x in copies.items():
        for length, times in key:
            covered[length] += x * times
    assert (covered >= 0.95 * number).all() and sum(copies.values()) <= 1.05 * (number @ np.arange(257)) / 256


@pytest.fixture(scope="module")
def texts(spark):
    draw = random.Random(4)
    prose = lambda n: " ".join("".join(draw.choices("abcdeé", k=draw.randint(1, 4))) + draw.choice(["", ".", ","]) for _ in range(n))
    out = [None, "", " ", "x", prose(6000), prose(3000)] + ["same words here"] * 60 + [prose(draw.randint(1, 300)) for _ in range(60)]
    rows = list(enumerate(out))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("piece", "length", "row", "bucket", "n", "terms", "rank", "item", "score"):
        df = df.withColumn(name, F.lit("clash"))
    return rows, df.repartition(5)


@pytest.mark.parametrize("bucket", [100_000, 7])
def test_fewest_windows(texts, bucket):
    rows, df = texts
    encode, window = WordEncoder(FILE).ids, 512
    twice = df.unionByName(df).unionByName(df.where("doc_id = 9").withColumn("doc_id", F.lit(None).cast("long")))
    for frame, times in ((df, 1), (twice, 2)):
        got = pack_into_fewest(frame, FILE, window=window, bucket=bucket).collect()
        for d, text in rows:
            ids = encode((text or "").encode()) + b"\x01\0\0\0"
            n = len(ids) // 4
            want = [(k, at, min(window, n - at), zlib.crc32(ids[4 * at:4 * (at + window)]))
                    for k, at in enumerate(range(0, n, window))]
            assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == d) == sorted(want * times)
        assert sum(r.doc_id is None for r in got) == times - 1
        ends = Counter()
        for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == ends[r.sequence_id]
            ends[r.sequence_id] += r.length
        assert max(ends.values()) <= window
        assert len(ends) <= 1.02 * sum(r.length for r in got) / window + 2
    assert pack_into_fewest(df.limit(0), FILE).count() == 0


def brute_ranking(docs, items, k=10):
    docs = [(d, Counter(TERM.findall(lower(t or "")))) for d, t in docs]
    docs = [(d, c) for d, c in docs if c]
    n_docs, length = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in docs:
            m = 100 - 75 + (75 * c.total() * n_docs) // length
            score = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t, r in Counter(TERM.findall(lower(text or ""))).items() if t in c)
            if score > 0 and d is not None:
                scored.append((-score, d))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("cells, index_bytes, chunk", [(1 << 21, 32 << 20, 1 << 20), (64, 12_000, 16)])
def test_ranked_search(spark, texts, monkeypatch, cells, index_bytes, chunk):
    """Also in tiny pieces: several groups of items, a few cells at a time, texts cut often."""
    for name, value in (("CELLS", cells), ("INDEX_BYTES", index_bytes), ("CHUNK", chunk)):
        monkeypatch.setattr(ranked_search, name, value)
    rows, df = texts
    items = [(k, t) for k, t in rows[60:90]] + [(500, None), (501, ""), (502, "Same SAME words nowhereelse"), (503, rows[4][1]),
                                               (503, "a b c"), (None, "same é")]
    asked = spark.createDataFrame(items, "item_id int, text string").withColumn("terms", F.lit(1)).withColumn("n", F.lit(1)).repartition(3)
    odd = df.unionByName(df.where("doc_id = 8").withColumn("doc_id", F.lit(None).cast("long"))).unionByName(df.where("doc_id in (7, 70)"))
    texts_of = rows + [(None, rows[8][1]), rows[7], rows[70]]
    got = rank_documents(odd, asked)
    assert sorted(map(tuple, got.collect()), key=str) == brute_ranking(texts_of, items)
    assert dict(got.dtypes) == {"item_id": "int", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    for a, b in ((odd.limit(0), asked), (odd, asked.limit(0)), (odd.where("doc_id < 3"), asked)):
        assert rank_documents(a, b).count() == 0


def test_terms_and_heaps():
    text = "A-b_c\x7fé\x80ÄZ09[x]`{}ß \x00İ中文1" * 3
    assert {t.decode(): n for t, n in term_counts(text.encode()).items()} == Counter(TERM.findall(lower(text)))
    assert term_counts(None) == term_counts(b"") == Counter()
    draw = np.random.default_rng(1)
    scores, docs = draw.integers(0, 6, (200, 7)), draw.permutation(200)
    for step in (1, 3, 50, 200):
        heaps = Heaps(7, 4)
        for k in range(0, 200, step):
            heaps.offer(docs[k:k + step], scores[k:k + step])
        for i in range(7):
            want = sorted((-s, d) for s, d in zip(scores[:, i], docs) if s > 0)[:4]
            assert list(zip(-heaps.score[i], heaps.doc[i])) == want


def test_hilbert_curve_moves_one_step_at_a_time():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = hilbert_keys(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_zone_bounds_hold_every_score():
    draw = np.random.default_rng(2)
    for scale in (100, 1 << 30):
        held, asked = (draw.integers(-scale, scale, (n, 5)) for n in (40, 9))
        least, most = bounds(asked, held.min(axis=0)[None], held.max(axis=0)[None])
        scores = products(asked, held)
        assert scores.tolist() == [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in held] for x in asked]
        assert (scores >= least).all() and (scores <= most).all()


def brute_negatives(rows):
    rows = [(v, (label + 1) % 10 if v % 7 == 0 else label, [math.floor(256 * x) for x in e]) for v, label, e in rows]
    out = []
    for a, label, x in rows:
        if a % 50:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), v, other) for v, other, y in rows if v != a)
        for s, p, _ in [r for r in scored if r[2] == label][:5]:
            fits = [r for r in scored if r[2] != label and 50 * -s <= 100 * -r[0] <= 95 * -s][:3]
            out += [(a, p, k + 1, v, -s, -t) for k, (t, v, _) in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("block, asks, zones", [(2048, 512, 256), (20, 5, 4)])
def test_hard_negatives(spark, monkeypatch, block, asks, zones):
    """Copies of one vector, ties, negative and zero scores, odd rows; in one block and in many."""
    for name, value in (("BLOCK", block), ("ASKS", asks), ("ZONES", zones)):
        monkeypatch.setattr(hard_negatives, name, value)
    draw = random.Random(5)
    centres = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(8)]
    rows = [(k, draw.randrange(10), [float(np.float32(c + draw.gauss(0, 0.4))) for c in draw.choice(centres)]) for k in range(500)]
    rows += [(k, k % 3, [0.5, -0.25, 1.0, 0.0, 2.0, -1.0]) for k in range(500, 700)]
    rows += [(700, 1, [0.0] * 6), (750, 77, [1.0] * 6), (-50, 2, [-1.0, 0.5, 0.25, 0.0, 0.0, 0.125])]
    bad = [(1000, 1, None), (1050, 1, []), (1100, 1, [float("nan")] * 6), (1150, 1, [1.0] * 5 + [None]), (1200, None, [1.0] * 6),
           (None, 1, [1.0] * 6), (1250, 1, [1.0] * 4), (1300, 1, [float("inf")] * 6)]
    schema = "vec_id long, label int, embedding array<float>"
    df = spark.createDataFrame(rows + bad + rows[:40], schema)
    for name in ("ask", "block", "vector", "key", "part", "score"):
        df = df.withColumn(name, F.lit("clash"))
    relabel = lambda vec_id, label: F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    got = mine_negatives(df.repartition(5), F.col("vec_id") % 50 == 0, relabel=relabel)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows)
    assert mine_negatives(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
