import random
import math
import re
from collections import Counter
from datetime import datetime

import pytest

import cellframe as cf
from test_products import random_cells


def stored(m):
    return Counter((r.i, r.j, r.v) for r in m.df.collect())


def test_rows_are_sorted_and_keep_duplicates(spark):
    m = cf.CooMatrix.from_cells(spark, [(0, 2, 1.0), (0, 1, 5.0), (0, 2, 1.0), (3, 0, 2.0)], 4, 3)
    packed = {r.i: [(c.j, c.v) for c in r.cells] for r in cf.pack_rows(m).df.collect()}
    assert packed == {0: [(1, 5.0), (2, 1.0), (2, 1.0)], 3: [(0, 2.0)]}
    packed = {r.j: [(c.i, c.v) for c in r.cells] for r in cf.pack_cols(m).df.collect()}
    assert packed == {0: [(3, 2.0)], 1: [(0, 5.0)], 2: [(0, 1.0), (0, 1.0)]}


def test_long_rows_are_held_in_bounded_records(spark):
    """A third of all cells on one row, half of those copies of one cell."""
    data = random_cells(7, 50, 60, 900, (0, 5)) + [(5, 9, 4.0)] * 450
    m = cf.CooMatrix.from_cells(spark, data, 50, 60)
    for pack in (cf.pack_rows, cf.pack_cols):
        p = pack(m, max_cells=40)
        assert stored(cf.unpack(p)) == Counter(data)
        records = p.df.collect()
        assert max(len(r.cells) for r in records) <= 80
        assert all(list(r.cells) == sorted(r.cells) for r in records)
        assert len(records) == len({(r[0], r.seg) for r in records})
    short = [r for r in cf.pack_rows(m, max_cells=40).df.collect() if r.i != 5]
    assert all(r.seg == 0 for r in short)


def test_products_do_not_depend_on_segments(spark):
    data = random_cells(8, 10, 20, 300, (0, 5))
    m = cf.CooMatrix.from_cells(spark, data, 10, 20)
    x = cf.Vector.from_values(spark, [float(k) for k in range(20)])
    expected = cf.spmv(m, x)
    for p in (cf.pack_rows(m, max_cells=16), cf.pack_cols(m, max_cells=16)):
        assert cf.vector_max_diff(cf.spmv(p, x), expected).first().max_diff == 0.0
        product = cf.spmm(p, m.T, format="csr")
        assert cf.matrix_max_diff(product, cf.spmm(m, m.T)).first().max_diff == 0.0


def test_transpose_drop_zeros_repartition_and_merge(spark):
    m = cf.CooMatrix.from_cells(spark, [(0, 1, 2.0), (0, 1, 3.0), (1, 0, 0.0), (1, 1, math.nan)], 2, 3)
    t = m.T
    assert (t.n_rows, t.n_cols) == (3, 2)
    kept = cf.drop_zeros(m).df.collect()
    assert len(kept) == 3 and sum(math.isnan(r.v) for r in kept) == 1
    assert cf.repartition_matrix(m, 5, "j").df.rdd.getNumPartitions() == 5
    merged = cf.merge_duplicates(m)
    assert merged.unique and merged.df.where("i = 0").first().v == 5.0
    assert cf.merge_duplicates(merged) is merged


def test_scale_rows(spark):
    d = cf.DenseRows.from_rows(spark, [[1.0, 2.0], [3.0, 4.0]])
    by = cf.Vector.from_entries(spark, [(1, 10.0)], 2)
    assert [(r.i, r.row) for r in cf.scale_rows(d, by).df.collect()] == [(1, [30.0, 40.0])]


def test_in_memory_and_views(spark):
    m = cf.CooMatrix.of(spark.createDataFrame([(0, 4, 1.5)], "i int, j int, v float")).register("one_cell")
    assert (m.n_rows, m.n_cols) == (1, 5)
    assert spark.sql("select i + j as s, v from one_cell").first() == (4, 1.5)
    assert m.df.dtypes == [("i", "bigint"), ("j", "bigint"), ("v", "double")]


def test_generators(spark):
    m = cf.random_coo(spark, 30, 20, 0.1, seed=3)
    found = m.df.collect()
    assert len(found) == 60 and m.df.repartition(7).count() == 60
    assert all(0 <= r.i < 30 and 0 <= r.j < 20 and 0 <= r.v < 10 for r in found)
    again = cf.random_coo(spark, 30, 20, 0.1, seed=3)
    assert stored(m) == stored(again)
    assert stored(m) != stored(cf.random_coo(spark, 30, 20, 0.1, seed=4))
    assert cf.random_coo(spark, 3, 3, 0.0, seed=1).df.count() == 1
    t = cf.random_tensor(spark, (4, 5, 6), 0.25, seed=1)
    assert t.df.count() == 30 and t.df.where("v < 0 or v >= 1 or i2 > 5 or i1 > 4 or i0 > 3").count() == 0
    d = cf.random_dense(spark, 4, 3, seed=1)
    assert d.df.count() == 4 and all(len(r.row) == 3 for r in d.df.collect())
    assert len({v for r in d.df.collect() for v in r.row}) == 12


def test_generators_are_plain_integer_arithmetic(spark):
    from cellframe.sources.random import P, Q, drawn_terms

    def draw(number, stream, seed):
        (f1, a1), (f2, a2), (f3, a3) = drawn_terms(stream, seed)
        x = (number % P * f1 + a1) % P
        x = (x * (x + f2) + a2 + (number >> 31)) % Q
        return (x * (x + f3) + a3) % P

    def below(number, n, stream, seed):
        return (draw(number, 2 * stream, seed) * 2**31 + draw(number, 2 * stream + 1, seed)) % n

    def uniform(number, stream, seed):
        return (draw(number, 2 * stream, seed) * 2**22 + (draw(number, 2 * stream + 1, seed) >> 9)) / 2**53

    found = stored(cf.random_coo(spark, 30, 2**40, 1e-11, seed=-3))
    assert sorted(found) == sorted(
        (below(k, 30, 0, -3), below(k, 2**40, 1, -3), uniform(k, 2, -3) * 10) for k in range(329))
    assert len({j for _, j, _ in found}) == 329
    rows = cf.random_dense(spark, 5, 7, seed=4).df.collect()
    assert {r.i: r.row for r in rows} == {i: [uniform(7 * i + r, 0, 4) for r in range(7)] for i in range(5)}
    # Far ids do not repeat near ones.
    assert len({draw(k + (h << 31), 0, 1) for k in range(100) for h in range(100)}) > 9990


def test_generated_numbers_are_even_and_independent(spark):
    import pyspark.sql.functions as F

    m = cf.random_coo(spark, 16, 16, 400.0, seed=11).df  # 400 cells a place
    places = [r["n"] for r in m.groupBy("i", "j").agg(F.count("*").alias("n")).collect()]
    assert len(places) == 256 and 160 < sum((n - 400) ** 2 / 400 for n in places) < 370
    got = m.agg(F.avg("v").alias("mean"), F.variance("v").alias("var"), F.corr("i", "v").alias("iv"), F.corr("j", "v").alias("jv")).first()
    assert abs(got.mean - 5) < 0.05 and abs(got["var"] - 100 / 12) < 0.15 and abs(got.iv) < 0.02 and abs(got.jv) < 0.02


def small_blocks(monkeypatch, few_values):
    from cellframe.plans import lookup

    for name, value in (("FEW_VALUES", few_values), ("STRETCH", 4), ("BLOCK", 16), ("LISTED", 7), ("NUMBERS_PER_TASK", 100)):
        monkeypatch.setattr(lookup, name, value, raising=False)


@pytest.mark.parametrize("query", ["random_coo", "random_tensor"])
def test_generated_cells_are_not_moved(spark, monkeypatch, folder, query):
    """Where Spark broadcasts no table, it moved every cell to its supplier and part."""
    from cellframe.workload.queries import QUERIES
    from cellframe.workload.views import SCHEMAS

    def table(name, rows, columns):
        given = spark.createDataFrame(rows, columns)
        full = [(f"`{c}`" if c in given.columns else f"CAST(NULL AS {kind})") + f" AS `{c}`"
                for c, kind in (field.split(" ") for field in SCHEMAS[name].split(", "))]
        given.selectExpr(*full).write.parquet(f"{folder}/{name}.parquet")

    table("supplier", [(i, i % 25) for i in range(150)], "s_suppkey bigint, s_nationkey int")
    table("part", [(j, j % 50) for j in range(400)], "p_partkey bigint, p_size int")
    table("lineitem", [(datetime(2001, 11, 30),)], "l_shipdate timestamp_ntz")
    want = sorted(QUERIES[query](spark, folder).collect())
    assert len(want) == {"random_coo": 600, "random_tensor": 996}[query]

    small_blocks(monkeypatch, 100)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES[query](spark, folder)
        assert sorted(df.collect()) == want
        assert not re.findall(r"Join \[i?[01ij]#", df._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("few_values", [0, 45, 1000])
def test_generated_cells_beside_vectors(spark, monkeypatch, few_values):
    """Looked up in blocks or joined: gaps, nulls, entries outside, and repeated entries, which are joined."""
    small_blocks(monkeypatch, few_values)
    made = cf.random_coo(spark, 40, 50, 0.4, seed=9).df.collect()
    assert len(made) == 800

    def vector(entries, length):
        return cf.Vector(spark.createDataFrame(entries, "i bigint, v double"), length)

    rows = [(i, None if i % 7 == 0 else float(i)) for i in range(0, 40, 3)] + [(None, 1.0), (None, 2.0), (-1, 3.0), (99, 4.0)]
    columns = [(j, j / 2) for j in range(50) if not 16 <= j < 32 and j != 48] + [(None, None)]
    for repeated in ([], [(3, 5.0), (3, 5.0)]):
        beside = {"i": ("a", vector(rows + repeated, 40)), "j": ("b", vector(columns, 50))}
        found = cf.random_coo(spark, 40, 50, 0.4, seed=9, known=beside).df
        assert found.dtypes == [("i", "bigint"), ("j", "bigint"), ("v", "double"), ("a", "double"), ("b", "double")]
        want = [(r.i, r.j, r.v, a, b) for r in made for i, a in rows + repeated if i == r.i for j, b in columns if j == r.j]
        assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want)) and want
    t = cf.random_tensor(spark, (40, 5, 50), 0.05, seed=2)
    beside = {"i2": ("b", vector(columns, 50)), "i0": ("a", vector(rows, 40))}
    found = cf.random_tensor(spark, (40, 5, 50), 0.05, seed=2, known=beside).df
    want = [(*r, b, a) for r in t.df.collect() for i, a in rows if i == r.i0 for j, b in columns if j == r.i2]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want)) and want


@pytest.mark.parametrize("lookup", [1 << 20, 0])
@pytest.mark.parametrize("max_cells", [1_000_000, 100])
@pytest.mark.parametrize("dense", [True, False])
def test_packed_dot(spark, monkeypatch, lookup, max_cells, dense):
    """Looked up or joined: long rows in several records, a short vector with gaps and repeated entries."""
    from cellframe.operators import layout

    monkeypatch.setattr(layout, "LOOKUP", lookup)
    data = random_cells(17, 40, 60, 700, (0, 3)) + [(41, 59, 2.0)]
    x = [(j, float(j % 7)) for j in range(0, 50, 3)] + [(3, 2.0)]
    want = {}
    for i, j, v in data:
        met = [xv for k, xv in x if k == j]
        if met or dense:
            want[i] = want.get(i, 0.0) + v * sum(met)
    m = cf.CooMatrix.from_cells(spark, data, 42, 60)
    vector = cf.Vector.from_entries(spark, x, 50)
    vector = cf.Vector(vector.df, 50, dense)
    packed = cf.pack_rows(m, max_cells)
    assert {r.i: r.v for r in layout.packed_dot(packed, vector).collect()} == want
    assert {r.i: r.v for r in cf.spmv(packed, vector).df.collect()} == want
    if dense:
        assert {r.i: r.v for r in cf.csr_row_dot(packed, vector).collect()} == want


def test_packed_dot_keeps_cells_where_packing_put_them(spark):
    m = cf.random_coo(spark, 200, 100, 0.2, seed=5)
    x = cf.Vector.from_values(spark, [float(k) for k in range(100)])
    out = cf.csr_row_dot(cf.pack_rows(m), x)
    assert out.count() == 200
    plan = out._jdf.queryExecution().executedPlan().toString()
    # The cells move once, to be packed; what else moves is the vector, on its way to the rows.
    cells = plan.split("Subquery")[0] + plan[plan.index("Generate inline"):]
    assert cells.count("Exchange") == 1 and "Join" not in cells


def test_positions_over_long_rows_and_fibers(spark):
    """Records are consecutive stretches: a long row reads in order, duplicates and all."""
    from cellframe.operators.layout import positions

    draw = random.Random(8)
    data = [(draw.choice([0, 0, 0, 1]), draw.randrange(300), float(draw.randrange(3))) for _ in range(1500)] + [(0, 7, 1.0)] * 400
    m = cf.CooMatrix.from_cells(spark, data, 2, 300)
    got = positions(cf.pack_rows(m, max_cells=100).df, 100).collect()
    for i in (0, 1):
        mine = [(r.c.j, r.c.v) for r in sorted((r for r in got if r.i == i), key=lambda r: r.pos)]
        assert mine == sorted((j, v) for r, j, v in data if r == i)
        assert sorted(r.pos for r in got if r.i == i) == list(range(len(mine)))
    entries = [((draw.randrange(2), draw.randrange(300), 0), 1.0) for _ in range(900)]
    t = cf.CooTensor.from_entries(spark, entries, (2, 300, 1))
    for r in (0, 1):
        at = sorted((x.pos, x.c.t) for x in positions(cf.tensor_fibers(t, 1, max_cells=100), 100).collect() if x.i0 == r)
        assert [x for _, x in at] == sorted({e[1] for e, _ in entries if e[0] == r})
        assert [p for p, _ in at] == list(range(len(at)))
