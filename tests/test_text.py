import math
import os

import pytest
from pyspark.errors import PySparkException

import cellframe as cf
from conftest import cells, entries, rows


def put(folder, text, name="input.txt"):
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def test_coo_lines(spark, folder):
    path = put(folder, "row,col,value\n# note\n\n1,2,3.5,extra\n0\t1\t2.0\r\n0, 1, 2.0\n0,1,inf\n+4,-1,1e2\n"
                       " 2,2,7 \n1,1\n1,x,3\n5,0, 6 \n3,3,1.5d\n3,4,,\n1.0,2,3\n")
    m = cf.read_coo(spark, path)
    assert cells(m) == {(1, 2): 3.5, (0, 1): 2.0, (4, -1): 100.0, (2, 2): 7.0, (5, 0): 6.0, (3, 3): 1.5}
    assert (m.n_rows, m.n_cols) == (6, 4)


def test_coo_special_numbers(spark, folder):
    path = put(folder, "0,0,NaN\n0,1,Infinity\n0,2,-Infinity\n0,3,nan\n0,4,INF\n0,5,infinity\n0,6,+inf\n0,7,1e999\n")
    found = cells(cf.read_coo(spark, path))
    assert math.isnan(found.pop((0, 0)))
    assert found == {(0, 1): math.inf, (0, 2): -math.inf, (0, 7): math.inf}


def test_coo_duplicates_and_given_dimensions(spark, folder):
    path = put(folder, "0,0,1\n0,0,2\n")
    m = cf.read_coo(spark, path, n_rows=10, n_cols=20)
    assert m.df.count() == 2 and (m.n_rows, m.n_cols) == (10, 20)


def test_coo_without_a_valid_line(spark, folder):
    path = put(folder, "a,b,c\n")
    with pytest.raises(ValueError, match="no valid entry"):
        cf.read_coo(spark, path)
    assert cf.read_coo(spark, path, 1, 1).df.count() == 0


def test_small_published_product(spark, folder):
    a = cf.CooMatrix.from_cells(spark, [(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0)], 2, 2)
    path = os.path.join(folder, "a")
    cf.write_coo(a, path)
    cf.write_coo(a, path)  # replaces what is there
    text = sorted(line for name in os.listdir(path) if name.startswith("part-")
                  for line in open(os.path.join(path, name)).read().splitlines())
    assert text == ["0,0,1.0", "0,1,2.0", "1,0,3.0"]
    assert cells(cf.read_coo(spark, path)) == cells(a)


def test_vector(spark, folder):
    path = put(folder, "index,value\n0,1.5\n# x\n3\t-2\textra\n4\n 1,2 \nx,3\n")
    x = cf.read_vector(spark, path)
    assert entries(x) == {0: 1.5, 3: -2.0, 1: 2.0} and x.length == 4
    out = os.path.join(folder, "x")
    cf.write_vector(x, out)
    assert entries(cf.read_vector(spark, out)) == entries(x)


def test_dense_csv(spark, folder):
    m = cf.read_dense_csv(spark, put(folder, "1,0,x\n# c\n0,2,\n"))
    assert cells(m) == {(0, 0): 1.0, (1, 1): 2.0}
    assert (m.n_rows, m.n_cols) == (2, 3)
    ragged = cf.read_dense_csv(spark, put(folder, "1,,\n\n,,,5\n", "ragged.txt"))
    assert cells(ragged) == {(0, 0): 1.0, (1, 3): 5.0} and (ragged.n_rows, ragged.n_cols) == (2, 1)


def test_dense_csv_then_product_is_finite(spark, folder):
    a = cf.read_dense_csv(spark, put(folder, "1,2\n0,3\n"))
    y = cf.spmv(a, cf.read_vector(spark, put(folder, "0,1\n1,1\n", "x.txt")))
    assert entries(y) == {0: 3.0, 1: 3.0}
    assert cf.nonfinite_count(y.df).first().bad == 0


def test_line_numbers_over_many_files_and_splits(spark, folder):
    total = 0
    for name, n in (("b.txt", 700), ("a.txt", 50), ("c.txt", 900)):
        lines = []
        for k in range(n):
            lines.append("" if k % 5 == 0 else "# skip" if k % 7 == 0 else str(0))
        put(folder, "\n".join(lines) + "\n", name)
    expected, number = {}, 0
    for name in sorted(os.listdir(folder)):
        path = os.path.join(folder, name)
        text = open(path).read().splitlines()
        marked = []
        for line in text:
            if line and not line.startswith("#"):
                marked.append(f"{number + 1},7")
                expected[number] = [number + 1.0, 7.0]
                number += 1
            else:
                marked.append(line)
        with open(path, "w") as f:
            f.write("\n".join(marked) + "\n")
    total = number
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        m = cf.read_dense_csv(spark, folder)
        assert m.df.rdd.getNumPartitions() >= 1
        assert (m.n_rows, m.n_cols) == (total, 2)
        assert cells(m) == {(i, c): v for i, row in expected.items() for c, v in enumerate(row)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_dense_rows(spark, folder):
    d = cf.read_dense_rows(spark, put(folder, "1, 2\n\n3,4e1\n"))
    assert rows(d) == {0: [1.0, 2.0], 1: [3.0, 40.0]} and (d.n_rows, d.n_cols) == (2, 2)
    bad = cf.read_dense_rows(spark, put(folder, "1,2\n3,y\n", "bad.txt"), 2, 2)
    for action in (lambda: bad.df.collect(), lambda: bad.df.count()):
        with pytest.raises(PySparkException, match="not a row of numbers"):
            action()
    comment = cf.read_dense_rows(spark, put(folder, "# 1\n", "comment.txt"), 1, 1)
    with pytest.raises(PySparkException, match="not a row of numbers"):
        comment.df.collect()


def test_tensor(spark, folder):
    t = cf.read_tensor(spark, put(folder, "# made by hand\n# shape: 2, 2 2\n0 1 1 5.0\n1,1,1,0.0\n1,0,\t0,-2\n"))
    assert t.shape == (2, 2, 2)
    assert sorted(tuple(r) for r in t.df.collect()) == [(0, 1, 1, 5.0), (1, 0, 0, -2.0)]
    out = os.path.join(folder, "t")
    cf.write_tensor(t, out)
    back = cf.read_tensor(spark, out)
    assert back.shape == t.shape and sorted(back.df.collect()) == sorted(t.df.collect())


@pytest.mark.parametrize("text, message", [
    ("# Shape: 2,2\n0,1\n", "expected 2 indices plus a value"),
    ("# Shape: 2,2\n0,2,1.0\n", "out of bounds for mode 1"),
    ("# Shape: 2,2\n-1,0,1.0\n", "out of bounds for mode 0"),
    ("# Shape: 2,2\n0,x,1.0\n", "index of mode 1 is not an integer"),
    ("# Shape: 2,2\n0,1,abc\n", "value is not numeric"),
])
def test_tensor_lines_that_do_not_fit(spark, folder, text, message):
    t = cf.read_tensor(spark, put(folder, text))
    for action in (lambda: t.df.collect(), lambda: t.df.count()):
        with pytest.raises(PySparkException, match=message):
            action()


def test_tensor_headers(spark, folder):
    with pytest.raises(ValueError, match="no `# Shape:` line"):
        cf.read_tensor(spark, put(folder, "0,0,1\n"))
    with pytest.raises(ValueError, match="at least one dimension"):
        cf.read_tensor(spark, put(folder, "# Shape:\n", "none.txt"))
    with pytest.raises(ValueError, match="not an integer"):
        cf.read_tensor(spark, put(folder, "# Shape: a\n", "word.txt"))
    assert cf.read_tensor(spark, put(folder, "#SHAPE : 3\n2 4\n", "case.txt")).shape == (3,)


def test_tensor_header_place(spark, folder):
    """The first header in file order counts, wherever it stands; odd file names are no patterns."""
    many = os.path.join(folder, "many files")
    os.mkdir(many)
    for name, text in (("a{1}[x] %.txt", "0 1 2\n"), ("b.txt", "1 1 3\n# Shape: 2 2\n"), ("c.txt", "# Shape: 9 9\n")):
        with open(os.path.join(many, name), "w") as f:
            f.write(text)
    t = cf.read_tensor(spark, many)
    assert t.shape == (2, 2) and sorted(map(tuple, t.df.collect())) == [(0, 1, 2.0), (1, 1, 3.0)]
    with open(os.path.join(many, "a{1}[x] %.txt"), "w") as f:
        f.write("# Shape: 3 3\n")
    assert cf.read_tensor(spark, many).shape == (3, 3)


def test_nulls_are_not_written(spark, folder):
    for write, part in (
        (cf.write_coo, cf.CooMatrix(spark.sql("SELECT 0L AS i, 1L AS j, CAST(NULL AS DOUBLE) AS v"), 2, 2)),
        (cf.write_vector, cf.Vector(spark.sql("SELECT 0L AS i, CAST(NULL AS DOUBLE) AS v"), 2)),
        (cf.write_dense_rows, cf.DenseRows(spark.sql("SELECT 0L AS i, array(1.0D, NULL, 3.0D) AS row"), 1, 3)),
    ):
        with pytest.raises(Exception, match="null cannot be written"):
            write(part, f"{folder}/x")


def test_line_numbers_do_not_depend_on_the_cores_of_later_scans(spark, folder):
    """The files would be cut elsewhere by a second scan; every line keeps its number."""
    spark.range(20000).selectExpr("concat(id, ',', id % 7) AS value").coalesce(1).write.text(f"{folder}/many")
    spark.conf.set("spark.sql.files.minPartitionNum", "2")
    try:
        m = cf.read_dense_rows(spark, f"{folder}/many", 20000, 2)
        spark.conf.set("spark.sql.files.minPartitionNum", "7")
        assert m.df.where("row[0] = i").count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
