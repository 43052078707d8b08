import itertools
import random

import pytest

import cellframe as cf
from cellframe.plans import fanout
from conftest import cells, close, entries, rows

A3 = [(0, 0, 1.0), (0, 2, 2.0), (1, 1, 3.0), (2, 0, 4.0), (2, 1, 5.0)]
A3_SQUARED = {(0, 0): 9.0, (0, 1): 10.0, (0, 2): 2.0, (1, 1): 9.0, (2, 0): 4.0, (2, 1): 15.0, (2, 2): 8.0}
FORMATS = ["coo", "csr", "csc", "csr_csc"]


@pytest.fixture
def a3(spark):
    return cf.CooMatrix.from_cells(spark, A3, 3, 3)


def random_cells(seed, rows_, cols, n, hot=None, whole=True):
    """Cells with duplicates; with ``hot=(axis, id)`` a third of them share that id."""
    rnd = random.Random(seed)
    out = []
    for t in range(n):
        c = [rnd.randrange(rows_), rnd.randrange(cols)]
        if hot and t % 3 == 0:
            c[hot[0]] = hot[1]
        out.append((*c, float(rnd.randrange(-9, 10)) if whole else rnd.random()))
    return out


def naive_product(a, b):
    by_k = {}
    for k, j, v in b:
        by_k.setdefault(k, []).append((j, v))
    out = {}
    for i, k, v in a:
        for j, w in by_k.get(k, []):
            out[(i, j)] = out.get((i, j), 0.0) + v * w
    return out


@pytest.mark.parametrize("layout", ["coo", "csr"])
def test_sparse_vector_drops_rows_that_meet_nothing(spark, a3, layout):
    x = cf.Vector.from_entries(spark, [(0, 2.0), (2, 1.0)], 3)
    y = cf.spmv(a3, x, format=layout)
    assert entries(y) == {0: 4.0, 2: 8.0}
    assert y.length == 3


@pytest.mark.parametrize("layout", ["coo", "csr"])
def test_dense_vector_keeps_every_row(spark, a3, layout):
    x = cf.Vector.from_values(spark, [2.0, 0.0, 1.0])
    assert entries(cf.spmv(a3, x, format=layout)) == {0: 4.0, 1: 0.0, 2: 8.0}


@pytest.mark.parametrize("layout", ["coo", "csr"])
def test_dense_vector_shorter_than_the_matrix_reads_zero(spark, a3, layout):
    x = cf.Vector.from_values(spark, [2.0])
    assert entries(cf.spmv(a3, x, format=layout)) == {0: 2.0, 1: 0.0, 2: 8.0}


def test_vector_and_matrix_duplicates_add_up(spark):
    a = cf.CooMatrix.from_cells(spark, [(0, 1, 2.0), (0, 1, 3.0)], 1, 2)
    x = cf.Vector.from_entries(spark, [(1, 1.0), (1, 10.0)], 2)
    for layout in ("coo", "csr"):
        assert entries(cf.spmv(a, x, format=layout)) == {0: 55.0}
    assert entries(cf.Vector(cf.spmv_sql(a, x), 1)) == {0: 55.0}


def test_spmv_checks_no_dimensions(spark, a3):
    x = cf.Vector.from_entries(spark, [(0, 1.0), (7, 5.0)], 99)
    assert entries(cf.spmv(a3, x)) == {0: 1.0, 2: 4.0}


@pytest.mark.parametrize("layout", FORMATS)
def test_square(a3, layout):
    c = cf.spmm(a3, a3, format=layout)
    assert cells(c) == A3_SQUARED
    assert (c.n_rows, c.n_cols) == (3, 3)


def test_sorted_sql_and_partitioned_products_agree(a3):
    ordered = [(r.i, r.j, r.v) for r in cf.spmm_sorted(a3, a3).collect()]
    assert ordered == [(i, j, v) for (i, j), v in sorted(A3_SQUARED.items())]
    assert {(r.i, r.j): r.v for r in cf.spmm_sql(a3, a3).collect()} == A3_SQUARED
    parts = cf.spmm(a3, a3, partitions=7)
    assert cells(parts) == A3_SQUARED


def test_packed_operands(a3):
    assert cells(cf.spmm(cf.pack_rows(a3), cf.pack_rows(a3), format="csr")) == A3_SQUARED
    assert cells(cf.spmm(cf.pack_cols(a3), cf.pack_cols(a3), format="csc")) == A3_SQUARED
    assert cells(cf.spmm(cf.pack_rows(a3), cf.pack_cols(a3), format="csr_csc")) == A3_SQUARED
    assert cells(cf.spmm(cf.pack_rows(a3), cf.pack_cols(a3))) == A3_SQUARED


def test_cancelled_cells_stay(spark):
    a = cf.CooMatrix.from_cells(spark, [(0, 0, 1.0), (0, 1, -1.0)], 1, 2)
    b = cf.CooMatrix.from_cells(spark, [(0, 0, 5.0), (1, 0, 5.0)], 2, 1)
    for layout in FORMATS:
        assert cells(cf.spmm(a, b, format=layout)) == {(0, 0): 0.0}


def test_incompatible_shapes_are_named(spark, a3):
    b = cf.CooMatrix.from_cells(spark, [(0, 0, 1.0)], 4, 2)
    for layout in FORMATS:
        with pytest.raises(ValueError, match="3x3.*4x2"):
            cf.spmm(a3, b, format=layout)
    with pytest.raises(ValueError, match="3x3.*4x2"):
        cf.spmm_sql(a3, b)
    with pytest.raises(ValueError, match="3x3.*2x2"):
        cf.spmm_dense(a3, cf.DenseRows.from_rows(spark, [[1, 2], [3, 4]]))
    with pytest.raises(ValueError, match="unknown format"):
        cf.spmm(a3, a3, format="ell")


def test_sparse_times_dense(spark, a3):
    d = cf.DenseRows.from_rows(spark, [[1.0, 2.0], [0.0, 3.0], [4.0, 5.0]])
    c = cf.spmm_dense(a3, d)
    assert rows(c) == {0: [9.0, 12.0], 1: [0.0, 9.0], 2: [4.0, 23.0]}
    assert (c.n_rows, c.n_cols) == (3, 2)


def test_sparse_times_dense_pads_short_rows_and_skips_unmet_rows(spark):
    a = cf.CooMatrix.from_cells(spark, [(0, 0, 2.0), (0, 1, 1.0), (1, 2, 1.0)], 2, 3)
    d = cf.DenseRows(spark.createDataFrame([(0, [1.0, 1.0, 1.0]), (1, [5.0])], "i bigint, row array<double>"), 3, 3)
    assert rows(cf.spmm_dense(a, d)) == {0: [7.0, 2.0, 2.0]}


def test_wide_dense_rows_take_the_other_aggregate(spark, a3):
    wide = 70
    values = [[float(i * wide + r) for r in range(wide)] for i in range(3)]
    c = rows(cf.spmm_dense(a3, cf.DenseRows.from_rows(spark, values)))
    expected = {i: [sum(v * values[j][r] for ii, j, v in A3 if ii == i) for r in range(wide)] for i in range(3)}
    assert c == expected


@pytest.mark.parametrize("layout", FORMATS)
@pytest.mark.parametrize("hot", [None, (1, 3), (0, 2)])
def test_random_product_with_duplicates(spark, layout, hot):
    a = random_cells(1, 20, 12, 400, hot)
    b = random_cells(2, 12, 15, 300, (0, 3) if hot else None)
    c = cf.spmm(cf.CooMatrix.from_cells(spark, a, 20, 12), cf.CooMatrix.from_cells(spark, b, 12, 15), format=layout)
    assert cells(c) == naive_product(a, b)


@pytest.mark.parametrize("merge_ratio", [1e9, 1])
@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
@pytest.mark.parametrize("layout", ["coo", "csr", "csc"])
def test_every_join_layout_gives_the_whole_product(spark, monkeypatch, layout, broadcast_bytes, merge_ratio):
    """Limits so small that tiny inputs take the cut, broadcast and merge branches."""
    monkeypatch.setattr(fanout, "PAIRS_PER_TASK", 200)
    monkeypatch.setattr(fanout, "MIN_PAIRS_PER_TASK", 20)
    monkeypatch.setattr(fanout, "BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr(fanout, "MERGE_RATIO", merge_ratio)
    a = random_cells(3, 30, 10, 300, (1, 4))
    b = random_cells(4, 10, 25, 200, (0, 4))
    c = cf.spmm(cf.CooMatrix.from_cells(spark, a, 30, 10), cf.CooMatrix.from_cells(spark, b, 10, 25), format=layout)
    assert cells(c) == naive_product(a, b)


def test_a_far_larger_side_is_not_hashed_on_k(spark, monkeypatch):
    monkeypatch.setattr(fanout, "MIN_PAIRS_PER_TASK", 20)
    a = random_cells(5, 30, 10, 900, (1, 4))
    b = [(k, 0, float(k)) for k in range(10)]
    left, right = cf.CooMatrix.from_cells(spark, a, 30, 10), cf.CooMatrix.from_cells(spark, b, 10, 1)
    assert cells(cf.spmm(left, right)) == naive_product(a, b)
    at = [(j, i, v) for i, j, v in a]
    bt = [(j, k, v) for k, j, v in b]
    assert cells(cf.spmm(right.T, left.T)) == naive_product(bt, at)


def test_hot_key_is_cut_into_blocks_of_bounded_work(spark, monkeypatch):
    monkeypatch.setattr(fanout, "PAIRS_PER_TASK", 100)
    monkeypatch.setattr(fanout, "MIN_PAIRS_PER_TASK", 10)
    monkeypatch.setattr(fanout, "BROADCAST_BYTES", 0)
    a = [(i, 0, 1.0) for i in range(200)] + [(i, 1, 1.0) for i in range(5)]
    b = [(0, j, 1.0) for j in range(100)] + [(1, j, 1.0) for j in range(5)]
    left = spark.createDataFrame([(k, i, v) for i, k, v in a], "k bigint, i bigint, va double")
    right = spark.createDataFrame([(k, j, v) for k, j, v in b], "k bigint, j bigint, vb double")
    left2, right2, keys = fanout.spread(left, right, True, True)
    assert keys == ["k", "lblock", "rblock"]
    pairs = left2.join(right2, keys)
    assert pairs.count() == 200 * 100 + 25
    assert pairs.select("k", "i", "j").distinct().count() == 200 * 100 + 25
    largest = pairs.groupBy(*keys).count().agg({"count": "max"}).first()[0]
    assert largest < 400  # blocks are hashed, so near 100 and never near 20000


def test_hot_key_without_partners_is_spread_too(spark, monkeypatch):
    """A third of the left cells share a key the right side does not have."""
    monkeypatch.setattr(fanout, "PAIRS_PER_TASK", 50)
    monkeypatch.setattr(fanout, "MIN_PAIRS_PER_TASK", 10)
    monkeypatch.setattr(fanout, "BROADCAST_BYTES", 0)
    a = [(i, 99, 1.0) for i in range(600)] + [(i, i % 40, 1.0) for i in range(1200)]
    b = [(k, 0, 1.0) for k in range(40)]
    left = spark.createDataFrame([(k, i, v) for i, k, v in a], "k bigint, i bigint, va double")
    right = spark.createDataFrame([(k, j, v) for k, j, v in b], "k bigint, j bigint, vb double")
    left2, right2, keys = fanout.spread(left, right, True, True)
    assert left2.where("k = 99").count() == 600
    assert left2.groupBy(*keys).count().agg({"count": "max"}).first()[0] < 120
    assert left2.join(right2, keys).count() == 1200


def test_grid_cuts_the_longer_side_first():
    assert fanout.grid(10, 1, 100) == (1, 1)
    assert fanout.grid(1000, 5, 100) == (50, 1)
    assert fanout.grid(5, 1000, 100) == (1, 50)
    assert fanout.grid(1000, 1000, 100) == (100, 100)
    assert fanout.grid(1000, 0, 100) == (10, 1)


def test_work_per_task_is_bounded(spark):
    cores = spark.sparkContext.defaultParallelism
    assert fanout.task_count(spark, 1000) == 0
    for load in (1e9, 1e12, 1e15):
        tasks = fanout.task_count(spark, load)
        assert load / tasks <= fanout.PAIRS_PER_TASK
        fan = fanout.FanOut(0, 0, load, 0, 0, 0, None)
        assert fanout.task_limit(fan, tasks) <= fanout.PAIRS_PER_TASK
    assert 1 < fanout.task_count(spark, fanout.MIN_PAIRS_PER_TASK * 2) <= cores


CHAIN_SHAPES = [(12, 3, 12, 3), (3, 12, 3, 12)]


@pytest.mark.parametrize("shape", CHAIN_SHAPES)
def test_chain(spark, shape):
    p, q, r, s = shape
    data = [random_cells(n, x, y, 40) for n, (x, y) in enumerate([(p, q), (q, r), (r, s)])]
    a, b, c = (cf.CooMatrix.from_cells(spark, d, x, y) for d, (x, y) in zip(data, [(p, q), (q, r), (r, s)]))
    ab = naive_product(data[0], data[1])
    expected = naive_product([(i, j, v) for (i, j), v in ab.items()], data[2])
    for order in (None, "AB_then_C", "A_then_BC"):
        close(cells(cf.spmm_chain3(a, b, c, order=order)), expected)
    with pytest.raises(ValueError, match="unknown order"):
        cf.spmm_chain3(a, b, c, order="C_first")


def test_chain_plan(spark):
    a = cf.random_coo(spark, 5000, 10, 0.1, 1)
    b = cf.random_coo(spark, 10, 5000, 0.1, 2)
    c = cf.random_coo(spark, 5000, 10, 0.1, 3)
    plan = cf.chain_plan(a, b, c).first()
    assert (plan.plan, plan.first_cost, plan.second_cost) == ("A_then_BC", 5000.0, 5000 * 5000 / 10)
    tie = cf.CooMatrix.from_cells(spark, [(0, 0, 1.0)], 1, 1)
    assert cf.chain_plan(tie, tie, tie).first().plan == "AB_then_C"
    empty = cf.CooMatrix(tie.df.where("false"), 0, 0)
    assert cf.chain_plan(empty, empty, empty).first().first_cost == 0.0


def test_stats(spark):
    m = cf.CooMatrix.from_cells(spark, [(0, 0, 1.0), (0, 0, 1.0)], 4, 5)
    assert tuple(cf.matrix_stats(m).first()) == (4, 5, 2)


def test_differences(spark, a3):
    x = cf.Vector.from_entries(spark, [(0, 1.0), (1, 5.0)], 3)
    y = cf.Vector.from_entries(spark, [(1, 3.0), (2, -7.0)], 3)
    assert cf.vector_max_diff(x, y).first().max_diff == 7.0
    nothing = cf.Vector(x.df.where("false"), 3)
    assert cf.vector_max_diff(nothing, nothing).first().max_diff == 0.0
    assert cf.matrix_max_diff(a3, a3).first().max_diff == 0.0
    assert cf.matrix_max_diff(a3, a3.T).first().max_diff == 5.0
    d = cf.DenseRows.from_rows(spark, [[1.0, 2.0], [3.0, 4.0]])
    e = cf.DenseRows.from_rows(spark, [[1.0, 2.5, 100.0], [3.0]])
    assert cf.dense_max_diff(d, e).first().max_diff == 0.5


def test_nonfinite(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),)], "v double")
    assert cf.nonfinite_count(df).first().bad == 3


def test_local_vectors_match_sparse_ones(spark, a3):
    x = cf.Vector.from_entries(spark, [(0, 2.0), (2, 1.0)], 3)
    dense = cf.Vector.from_values(spark, [2.0, 0.0, 1.0])
    ys = [cf.spmv(a3, v, format=f) for v, f in itertools.product([x, dense], ["coo", "csr"])]
    for y in ys[1:]:
        assert cf.vector_max_diff(ys[0], y).first().max_diff <= 1e-6


@pytest.mark.parametrize("order", [None, "AB_then_C", "A_then_BC"])
@pytest.mark.parametrize("limit", [500_000, 3])
def test_chain_laid_out_from_bounds(spark, monkeypatch, order, limit):
    """With duplicates, hot rows and columns; small enough for one task, and with tasks and a broadcast."""
    monkeypatch.setattr(fanout, "MIN_PAIRS_PER_TASK", limit)
    rnd = random.Random(9)
    draw = lambda n, r, c: [(rnd.choice([0, rnd.randrange(r)]), rnd.choice([0, rnd.randrange(c)]), float(rnd.randint(1, 4))) for _ in range(n)]
    a, b, c = draw(60, 20, 5), draw(40, 5, 20), draw(50, 20, 4)
    want = {}
    for i, k, x in a:
        for k2, m, y in b:
            for m2, j, z in c:
                if k == k2 and m == m2:
                    want[i, j] = want.get((i, j), 0.0) + x * y * z
    matrices = [cf.CooMatrix.from_cells(spark, m, *s) for m, s in ((a, (20, 5)), (b, (5, 20)), (c, (20, 4)))]
    assert cells(cf.spmm_chain3(*matrices, order=order)) == want


def test_pairs_are_bounded_by_unique_sides():
    assert fanout.most_pairs(10, 20, False, False, 5, 6) == 200
    assert fanout.most_pairs(10, 20, False, True, 5, 6) == 60
    assert fanout.most_pairs(10, 20, True, True, 2, 6) == 40
