import itertools
import random

import pytest
from pyspark.sql import functions as F

import cellframe as cf
from conftest import close, rows

F3 = [[[1.0, 0.5], [0.3, 1.2]], [[1.1, 0.7], [0.8, 1.5]], [[0.9, 1.3], [1.4, 0.6]]]
F3B = [[[0.6, 1.1], [1.5, 0.2]], [[0.4, 0.9], [1.2, 1.7]], [[1.0, 0.3], [0.8, 1.6]]]
FDUP = [[[1.0, 0.5], [0.4, 1.2]], [[1.0, 0.3], [0.9, 1.1]], [[1.0, 1.0]]]
FSKEW = [[[0.6, 1.1, 0.2], [1.4, 0.5, 0.9]], [[0.3, 0.8, 1.0], [1.2, 0.7, 0.4]], [[0.5, 1.3, 0.6], [0.9, 0.2, 1.1]]]
F4 = [[[0.9, 0.1, 0.4], [1.2, 0.3, 0.7]], [[0.5, 0.8, 0.6], [1.1, 0.4, 0.2]],
      [[0.7, 0.6, 1.0], [0.9, 1.3, 0.5]], [[0.3, 0.4, 0.9], [1.4, 0.2, 0.1], [0.8, 1.1, 0.5]]]
FRONT = [[[0.6, 1.0, 0.3], [0.9, 0.2, 1.1]], [[1.2, 0.7, 0.5], [0.4, 0.8, 1.3]], [[0.5, 1.4, 0.6], [1.0, 0.3, 0.9]]]
ONES = [[[1.0, 1.0], [1.0, 1.0]]] * 3
SKEWED = [((0, 0, 0), float(n % 3 + 1)) for n in range(50)] + [((1, 1, 1), 6.0)]

CASES = {
    "three_way": ([((0, 0, 0), 1), ((1, 0, 1), 2), ((0, 1, 1), 3)], (2, 2, 2), F3, 1,
                  {0: [1.74, 2.09], 1: [4.2, 0.9]}),
    "mode_0": ([((0, 0, 1), 4), ((1, 1, 0), 5)], (2, 2, 2), F3B, 0, {0: [1.28, 5.76], 1: [6.0, 2.55]}),
    "duplicates": ([((0, 0, 0), 1), ((0, 0, 0), 2.5), ((1, 1, 0), 3)], (2, 2, 1), FDUP, 0,
                   {0: [3.5, 1.05], 1: [2.7, 3.3]}),
    "skew": (SKEWED, (2, 2, 2), FSKEW, 2, {0: [17.82, 87.12, 19.8], 1: [10.08, 2.1, 2.16]}),
    "four_way": ([((0, 0, 0, 0), 1.5), ((1, 1, 1, 2), 2), ((0, 1, 0, 1), 0.75), ((1, 0, 1, 0), 3.2)],
                 (2, 2, 2, 3), F4, 2, {0: [1.242, 0.054, 0.33], 1: [2.688, 0.5712, 1.3496]}),
    "coo_is_fiber": ([((0, 0, 0), 0.8), ((0, 1, 1), 1.1), ((1, 0, 1), 2.4), ((1, 1, 0), 3.3)], (2, 2, 2), FRONT, 1,
                     {0: [2.4, 1.264, 2.52], 1: [2.145, 1.254, 2.475]}),
    "frontend": ([((0, 0, 0), 1), ((0, 1, 1), 0.5), ((1, 0, 1), 2)], (2, 2, 2), FRONT, 1,
                 {0: [2.1, 1.52, 2.16], 1: [0.3, 0.15, 0.135]}),
    "known": ([((0, 0, 0), 1), ((0, 0, 1), 2), ((1, 1, 0), 3), ((1, 1, 1), 4)], (2, 2, 2), ONES, 0,
              {0: [3.0, 3.0], 1: [7.0, 7.0]}),
}


def factors_of(spark, values):
    return [cf.DenseRows.from_rows(spark, f) for f in values]


@pytest.mark.parametrize("method", ["coo", "fiber"])
@pytest.mark.parametrize("case", CASES)
def test_known_answers(spark, case, method):
    entries, shape, values, mode, expected = CASES[case]
    t = cf.CooTensor.from_entries(spark, entries, shape)
    if case == "skew":
        t = cf.CooTensor(t.df.repartition(16), t.shape)
    out = cf.mttkrp(t, factors_of(spark, values), mode, method=method)
    close(rows(out), expected, 1e-5 if case == "skew" else 1e-6)
    assert (out.n_rows, out.n_cols) == (shape[mode], len(values[0][0]))


@pytest.mark.parametrize("method", ["coo", "fiber"])
def test_empty_tensor(spark, method):
    t = cf.CooTensor.from_entries(spark, [], (2, 3, 1))
    values = [[[1.0] * 3] * n for n in (2, 3, 1)]
    assert rows(cf.mttkrp(t, factors_of(spark, values), 1, method=method)) == {}


@pytest.mark.parametrize("method", ["coo", "fiber"])
def test_one_way_repeats_the_sum(spark, method):
    t = cf.CooTensor.from_entries(spark, [((0,), 1.0), ((0,), 2.0), ((2,), 5.0)], (3,))
    out = cf.mttkrp(t, factors_of(spark, [[[9.0, 9.0]] * 3]), 0, method=method)
    assert rows(out) == {0: [3.0, 3.0], 2: [5.0, 5.0]}


@pytest.mark.parametrize("method", ["coo", "fiber"])
def test_missing_factor_row_drops_the_entry(spark, method):
    t = cf.CooTensor.from_entries(spark, [((0, 0), 1.0), ((1, 1), 1.0)], (2, 2))
    f = factors_of(spark, [[[1.0], [1.0]], [[2.0], [3.0]]])
    f[1] = cf.DenseRows(f[1].df.where("i = 0"), 2, 1)
    assert rows(cf.mttkrp(t, f, 0, method=method)) == {0: [2.0]}


@pytest.mark.parametrize("rank", [1, 70])
@pytest.mark.parametrize("mode", [0, 1, 2])
def test_random_against_a_loop(spark, mode, rank):
    rnd = random.Random(rank + mode)
    shape = (5, 4, 3)
    entries = [(tuple(rnd.randrange(n) for n in shape), float(rnd.randrange(1, 5))) for _ in range(60)]
    values = [[[float(rnd.randrange(-3, 4)) for _ in range(rank)] for _ in range(n)] for n in shape]
    expected = {}
    for coords, v in entries:
        row = expected.setdefault(coords[mode], [0.0] * rank)
        for r in range(rank):
            term = v
            for m in range(3):
                if m != mode:
                    term *= values[m][coords[m]][r]
            row[r] += term
    t = cf.CooTensor.from_entries(spark, entries, shape)
    for method in ("coo", "fiber"):
        assert rows(cf.mttkrp(t, factors_of(spark, values), mode, method=method)) == expected


def test_fibers_merge_sort_and_stay_bounded(spark):
    entries = [((0, n % 30, 0), 1.0) for n in range(90)] + [((1, 2, 0), 7.0)]
    t = cf.CooTensor.from_entries(spark, entries, (2, 30, 1))
    whole = {(r.i0, r.i2, r.seg): [(c.t, c.v) for c in r.cells] for r in cf.tensor_fibers(t, 1).collect()}
    assert whole == {(0, 0, 0): [(n, 3.0) for n in range(30)], (1, 0, 0): [(2, 7.0)]}
    cut = cf.tensor_fibers(t, 1, max_cells=8).collect()
    assert max(len(r.cells) for r in cut) <= 8
    assert sorted(c.t for r in cut if r.i0 == 0 for c in r.cells) == list(range(30))


def test_rejections(spark):
    t = cf.CooTensor.from_entries(spark, [((0, 0, 0), 1.0)], (2, 2, 2))
    f = factors_of(spark, ONES)
    with pytest.raises(ValueError, match="got 2 factors"):
        cf.mttkrp(t, f[:2], 0)
    with pytest.raises(ValueError, match="differ in rank"):
        cf.mttkrp(t, [*f[:2], *factors_of(spark, [[[1.0] * 3] * 2])], 0)
    with pytest.raises(ValueError, match="needs 2 rows"):
        one_row = factors_of(spark, [[[1.0, 1.0]]] * 3)
        cf.mttkrp(cf.CooTensor(t.df, (2, 1, 1)), one_row, 0)
    for mode in (3, -1):
        with pytest.raises(ValueError, match="there is no mode"):
            cf.mttkrp(t, f, mode)
    with pytest.raises(ValueError, match="unknown method"):
        cf.mttkrp(t, f, 0, method="csf")
    with pytest.raises(ValueError, match="at least one dimension"):
        cf.CooTensor(t.df, ())


@pytest.mark.parametrize("method", ["coo", "fiber"])
def test_short_factor_row_is_an_error(spark, method):
    t = cf.CooTensor.from_entries(spark, [((0, 1, 1), 2.0)], (2, 2, 2))
    f = factors_of(spark, ONES)
    short = cf.DenseRows(f[1].df.withColumn("row", F.slice("row", 1, F.when(F.col("i") == 1, 1).otherwise(2))), 2, f[1].n_cols)
    with pytest.raises(Exception, match="shorter than"):
        cf.mttkrp(t, [f[0], short, f[2]], 0, method=method).df.collect()


def test_coordinate_arrays(spark):
    t = cf.CooTensor.from_entries(spark, [((0, 1), 2.0)], (2, 2))
    back = cf.CooTensor.from_coords(t.with_coords(), (2, 2))
    assert back.df.collect() == t.df.collect()


@pytest.fixture
def dealing(monkeypatch):
    """Tables of any size look long rows up in tasks of 50 cells."""
    from cellframe.plans import lookup

    monkeypatch.setattr(lookup, "CELLS_PER_TASK", 50)
    monkeypatch.setattr(lookup, "FEW_VALUES", 0)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("method", ["coo", "fiber"])
@pytest.mark.parametrize("mode", [0, 1])
def test_cells_are_dealt_by_their_number(spark, dealing, mode, method, hot):
    """Missing factor rows, cells without a coordinate, and with ``hot`` ids that have too many cells for a task."""
    rng, shape, rank = random.Random(mode), (30, 200, 40), 2
    entries = [(tuple(rng.randrange(n) for n in shape), float(rng.randrange(9))) for _ in range(690)]
    if hot:
        entries += [((3, 7, 11), 1.0)] * 300 + [((n % 30, 9, 5), 2.0) for n in range(200)]
    t = cf.CooTensor.from_entries(spark, entries, shape)
    gaps = spark.createDataFrame([(1, None, 2, 5.0), (2, 3, None, 5.0), (None, 3, 4, 5.0)], t.df.schema)
    gap = gaps.where(F.col(f"i{mode}").isNotNull())  # in another mode than the target: such a cell meets nothing
    values = [[[float((7 * i + 3 * r + m) % 5 - 2) for r in range(rank)] for i in range(n)] for m, n in enumerate(shape)]
    factors = factors_of(spark, values)
    factors = [cf.DenseRows(f.df.where("i <> 13"), f.n_rows, rank) for f in factors]
    out = cf.mttkrp(cf.CooTensor(t.df.unionByName(gap), shape), factors, mode, method=method)
    want = {}
    others = [m for m in range(3) if m != mode]
    for at, v in entries:
        if all(at[m] != 13 for m in others):
            row = want.setdefault(at[mode], [0.0] * rank)
            for r in range(rank):
                row[r] += v * values[others[0]][at[others[0]]][r] * values[others[1]][at[others[1]]][r]
    close(rows(out), want)
    # Not as many tasks as there are cores or shuffle partitions, four of each, but as many as the cells need.
    assert f", {24 if hot else 14}), REPARTITION_BY_NUM" in out.df._jdf.queryExecution().executedPlan().toString()


def test_only_many_cells_and_long_rows_are_dealt(spark, monkeypatch):
    from cellframe.plans import lookup

    cells = spark.range(1000).selectExpr("id % 10 AS i", "id AS j", "1.0D AS v")
    rows_ = spark.range(1000).selectExpr("id AS j", "array(1.0D, 2.0D) AS row")

    def dealt():
        plan = lookup.look_up(cells, rows_, "j", 2000)._jdf.queryExecution().executedPlan().toString()
        return "REPARTITION_BY_NUM" in plan

    assert not dealt()
    monkeypatch.setattr(lookup, "FEW_VALUES", 1999)
    assert not dealt()
    monkeypatch.setattr(lookup, "CELLS_PER_TASK", 100)
    assert dealt()
    monkeypatch.setattr(lookup, "FEW_VALUES", 2000)
    assert not dealt()


@pytest.mark.parametrize("hot", [False, True])
def test_sparse_times_dense_deals_its_cells(spark, dealing, hot):
    """Missing, repeated, short and null rows of the dense side, cells without a column, and ids of too many cells."""
    rng = random.Random(9)
    cells = [(rng.randrange(30), rng.randrange(200), float(rng.randrange(9))) for _ in range(690)]
    if hot:
        cells += [(n % 30, 7, 1.0) for n in range(300)] + [(3, 9, 2.0)] * 200
    table = [(j, [float((7 * j + 3 * r) % 5 - 2) for r in range(2)]) for j in range(200) if j != 13]
    table += [(7, [4.0, 1.0]), (9, [5.0]), (21, None)]
    a = spark.createDataFrame(cells + [(1, None, 5.0)], "i bigint, j bigint, v double")
    d = cf.DenseRows(spark.createDataFrame(table + [(None, [1.0, 1.0])], "i bigint, row array<double>"), 200, 2)
    out = cf.spmm_dense(cf.CooMatrix(a, 30, 200), d)
    want = {}
    for i, j, v in cells:
        for row in (row for k, row in table if k == j):
            sums = want.setdefault(i, [0.0, 0.0])
            for r, x in enumerate(row or []):
                sums[r] += v * x
    close(rows(out), want)
    assert f", {24 if hot else 14}), REPARTITION_BY_NUM" in out.df._jdf.queryExecution().executedPlan().toString()


def test_difference_of_a_product_and_dealt_sums(spark, dealing):
    rng = random.Random(4)
    entries = [((rng.randrange(6), rng.randrange(90), rng.randrange(5)), float(rng.randrange(9))) for _ in range(400)]
    t = cf.CooTensor.from_entries(spark, entries + [((6, 1, 1), 1.0)], (7, 90, 5))
    values = [[[float((7 * i + 3 * r + m) % 5 - 2) for r in range(2)] for i in range(n)] for m, n in enumerate(t.shape)]
    a = cf.CooMatrix(t.df.where("i0 < 6").selectExpr("i0 AS i", "i1 AS j", "v"), 7, 90)
    left = cf.spmm_dense(a, cf.DenseRows.from_rows(spark, values[1]))
    right = cf.mttkrp(t, factors_of(spark, values), 0)
    want = {}
    for (i, j, k), v in entries:
        for r in range(2):
            want[i, r] = want.get((i, r), 0.0) + v * values[1][j][r] * (1 - values[2][k][r])
    out = cf.dense_max_diff(left, right)
    assert out.first().max_diff == max(abs(d) for d in want.values())
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
