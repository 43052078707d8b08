"""SQL building blocks for the checks in DuckDB: the views of ``views.py`` as common table expressions."""

from __future__ import annotations

from cellframe.sources.random import P, Q, drawn_terms

MONTH = "((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1)::BIGINT"
FLAG = "(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END)::BIGINT"
N_SUPPLIERS = "(SELECT max(s_suppkey) + 1 FROM supplier)"
N_CUSTOMERS = "(SELECT max(c_custkey) + 1 FROM customer)"
N_PARTS = "(SELECT max(p_partkey) + 1 FROM part)"
N_MONTHS = f"(SELECT max({MONTH}) + 1 FROM lineitem)"

CTES = {
    "a": "SELECT l_suppkey AS i, l_partkey AS j, l_quantity AS v FROM lineitem",
    "b": f"SELECT l_partkey AS i, {MONTH} AS j, l_quantity AS v FROM lineitem",
    "c_raw": f"SELECT {MONTH} AS i, {FLAG} AS j, l_quantity AS v FROM lineitem",
    "c_sum": f"SELECT {MONTH} AS i, {FLAG} AS j, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2",
    "xs": "SELECT p_partkey AS i, p_size::DOUBLE AS v FROM part WHERE p_size > 25",
    "xd": "SELECT p_partkey AS i, p_size::DOUBLE AS v FROM part",
    "xshort": "SELECT s_suppkey AS i, s_nationkey::DOUBLE AS v FROM supplier",
    "d": "SELECT p_partkey AS i, unnest([0, 1, 2, 3])::BIGINT AS r, "
         "unnest([p_size, length(p_name), length(p_type), length(p_brand)])::DOUBLE AS v FROM part",
    "ab": "SELECT a.i, b.j, sum(a.v * b.v) AS v FROM a JOIN b ON a.j = b.i GROUP BY 1, 2",
    "t": f"SELECT l_suppkey AS i0, l_partkey AS i1, {MONTH} AS i2, (l_linenumber - 1)::BIGINT AS i3, "
         "l_quantity AS v FROM lineitem",
    "ranks": "SELECT unnest(range(4))::BIGINT AS r",
    "e": f"SELECT CASE WHEN l_returnflag = 'A' AND s_acctbal >= 0 THEN l_suppkey ELSE {N_SUPPLIERS} + o_custkey END AS i, "
         f"CASE WHEN l_returnflag = 'A' AND s_acctbal >= 0 THEN {N_SUPPLIERS} + o_custkey ELSE l_suppkey END AS j "
         "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey",
    "n": f"SELECT {N_SUPPLIERS} + {N_CUSTOMERS} AS n",
    "node": "SELECT unnest(range(n))::BIGINT AS i FROM n",
    "deg": "SELECT i, count(*) AS degree FROM e GROUP BY i",
    "m": "SELECT e.i, e.j, 1.0::DOUBLE / degree AS v FROM e JOIN deg ON e.i = deg.i",
    "dangling": "SELECT i FROM node WHERE i NOT IN (SELECT i FROM deg)",
}
NEEDS = {
    "ab": ["a", "b"], "node": ["n"], "deg": ["e"], "m": ["e", "deg"],
    "dangling": ["node", "deg", "n", "e"],
}


def with_views(names: str, body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``body`` after the named views, those they need, and further ones."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        add(name)
    parts = [f"{name} AS ({CTES[name]})" for name in wanted]
    parts += [f"{name} AS MATERIALIZED ({sql})" for name, sql in extra or []]
    return f"WITH {', '.join(parts)} {body}"


def factor(mode: int) -> str:
    return f"((i{mode} * 7 + r * 3 + {mode}) % 11 - 5)::DOUBLE"


def mttkrp_sql(order: int, target: int) -> str:
    terms = " * ".join(["v", *[factor(m) for m in range(order) if m != target]])
    return with_views("t ranks", f"SELECT i{target} AS i, r, sum({terms}) AS v FROM t CROSS JOIN ranks GROUP BY 1, 2")


def pagerank_sql(turns: int, body: str) -> str:
    """Turns of PageRank as one chain of expressions; ``body`` reads the last one as ``final``."""
    steps = [("r0", "SELECT i, 1.0::DOUBLE / n AS v FROM node, n")]
    for t in range(1, turns + 1):
        before = f"r{t - 1}"
        steps.append((f"r{t}", (
            f"SELECT node.i, 0.85::DOUBLE * coalesce(y.v, 0) + 0.15::DOUBLE / n.n + 0.85::DOUBLE * lost.v / n.n AS v "
            f"FROM node CROSS JOIN n "
            f"CROSS JOIN (SELECT coalesce(sum(v), 0) AS v FROM {before} JOIN dangling USING (i)) lost "
            f"LEFT JOIN (SELECT m.j AS i, sum(m.v * {before}.v) AS v FROM m JOIN {before} ON m.i = {before}.i "
            f"GROUP BY m.j) y ON node.i = y.i")))
    steps.append(("final", f"SELECT i, v FROM r{turns}"))
    return with_views("m node n dangling", body, steps)


def _hash_sql(number: str, stream: int, seed: int) -> str:
    (f1, a1), (f2, a2), (f3, a3) = drawn_terms(stream, seed)
    first = f"(({number} % {P} * {f1} + {a1}) % {P})"
    second = f"(({first} * ({first} + {f2}) + {a2} + ({number} >> 31)) % {Q})"
    return f"(({second} * ({second} + {f3}) + {a3}) % {P})"


def below_sql(number: str, n: str, stream: int, seed: int) -> str:
    """The whole number in [0, n) that the generators draw for a record."""
    high, low = (_hash_sql(number, 2 * stream + half, seed) for half in (0, 1))
    return f"(({high} * {2**31} + {low}) % {n})::BIGINT"


def uniform_sql(number: str, stream: int, seed: int) -> str:
    """The number in [0, 1) that the generators draw for a record."""
    high, low = (_hash_sql(number, 2 * stream + half, seed) for half in (0, 1))
    return f"(({high} * {2**22} + ({low} >> 9))::DOUBLE / {2**53}::DOUBLE)"


def records_sql(n: str) -> str:
    """Record numbers as column `id`."""
    return f"SELECT unnest(range(n))::BIGINT AS id FROM (SELECT ({n})::BIGINT AS n)"
