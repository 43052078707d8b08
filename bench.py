"""Time the headline queries and print one JSON line.

``$BENCH_SF_DIR`` names the tables (default /root/testdata/sf0.1) and ``$BENCH_CPUS`` the cores (default
8). Each entry is run once to warm up and then timed once. Keys without a prefix are registered
queries, timed from opening the tables to the last row. Keys ``gen_*`` repeat published
configurations on generated matrices, which are made and cached before the clock starts; the total
leaves them out. First (cold) times go to stderr.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import cellframe as cf
from cellframe.session import build_session
from cellframe.workload.queries import QUERIES

HEADLINE = [
    "spmv_coo_sparse", "spmv_csr_sparse", "spmv_coo_dense", "spmv_csr_dense", "spmv_dataframe", "spmv_sql",
    "spmm_coo", "spmm_csr", "spmm_csc", "spmm_csr_csc", "spmm_dense", "spmm_dense_embeddings",
    "spmm_dataframe_sorted", "spmm_sql", "spmm_partitions",
    "mttkrp_coo_mode0", "mttkrp_coo_mode1", "mttkrp_coo_mode2",
    "mttkrp_fiber_mode0", "mttkrp_fiber_mode1", "mttkrp_fiber_mode2", "mttkrp_4way",
    "spmm_chain3", "spmm_chain3_ab_first", "spmm_chain3_bc_first",
    "coo_to_csr", "tensor_fibers", "transition_matrix", "pagerank",
    "read_coo", "read_dense_csv", "read_tensor",
]


def run(df) -> None:
    """Compute every row and column, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def timed(name: str, make) -> float:
    seconds = []
    for _ in range(2):
        start = time.perf_counter()
        run(make())
        seconds.append(round(time.perf_counter() - start, 3))
    print(f"{name}: first {seconds[0]}, then {seconds[1]}", file=sys.stderr)
    return seconds[1]


def generated(spark) -> dict[str, float]:
    """The published SpMV, SpMM and chain configurations."""

    def matrix(rows: int, cols: int, density: float, seed: int) -> cf.CooMatrix:
        m = cf.random_coo(spark, rows, cols, density, seed)
        m = m.with_df(m.df.cache())
        m.df.count()
        return m

    seconds = {}

    def clock(name: str, make) -> None:
        seconds[f"gen_{name}"] = timed(f"gen_{name}", make)

    a = matrix(10000, 10000, 0.01, 1)
    x = cf.Vector.of(spark.range(10000).selectExpr("id AS i", "CAST(id % 10 AS double) AS v"), 10000, unique=True)
    for layout in ("coo", "csr"):
        clock(f"spmv_10000_d0.01_{layout}", lambda: cf.spmv(a, x, format=layout).df)
    clock("spmv_10000_d0.01_sql", lambda: cf.spmv_sql(a, x))
    a.df.unpersist()
    for n, density in ((500, 0.3), (1000, 0.3)):
        a, b = matrix(n, n, density, 2), matrix(n, n, density, 3)
        for layout in ("coo", "csr_csc"):
            clock(f"spmm_{n}_d{density}_{layout}", lambda: cf.spmm(a, b, format=layout).df)
        clock(f"spmm_{n}_d{density}_sql", lambda: cf.spmm_sql(a, b))
        a.df.unpersist()
        b.df.unpersist()
    for density in (0.1, 0.2, 0.3, 0.4):
        a, b, c = matrix(5000, 10, density, 4), matrix(10, 5000, density, 5), matrix(5000, 10, density, 6)
        clock(f"chain_d{density}_chosen", lambda: cf.spmm_chain3(a, b, c).df)
        clock(f"chain_d{density}_other", lambda: cf.spmm_chain3(a, b, c, order="AB_then_C").df)
        for m in (a, b, c):
            m.df.unpersist()
    for shape in ((300, 300, 300), (200, 400, 800)):
        t = cf.random_tensor(spark, shape, 0.001, 7)
        t = cf.CooTensor(t.df.cache(), t.shape)
        factors = [cf.random_dense(spark, n, 32, 8 + m) for m, n in enumerate(shape)]
        t.df.count()
        for method in ("coo", "fiber"):
            clock(f"mttkrp_{'x'.join(map(str, shape))}_r32_{method}", lambda: cf.mttkrp(t, factors, 0, method=method).df)
        t.df.unpersist()
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    spark = build_session(f"local[{cpus}]", cpus, app="bench")
    run(QUERIES["spmm_coo"](spark, sf_dir))
    seconds = {}
    for name in only or HEADLINE:
        seconds[name] = timed(name, lambda: QUERIES[name](spark, sf_dir))
    total = round(sum(seconds.values()), 3)
    if not only:
        seconds.update(generated(spark))
    print(json.dumps({
        "metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
