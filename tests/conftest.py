import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cellframe.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4, app="tests", memory="6g")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def cells(m):
    """Matrix as {(i, j): v}, sums of duplicates."""
    out = {}
    for r in m.df.collect():
        out[(r.i, r.j)] = out.get((r.i, r.j), 0.0) + r.v
    return out


def entries(x):
    return {r.i: r.v for r in x.df.collect()}


def rows(d):
    return {r.i: list(r.row) for r in d.df.collect()}


def close(a, b, tolerance=1e-6):
    assert a.keys() == b.keys()
    for k in a:
        left, right = a[k], b[k]
        if isinstance(left, list):
            assert len(left) == len(right)
        else:
            left, right = [left], [right]
        assert all(abs(x - y) <= tolerance for x, y in zip(left, right)), (k, a[k], b[k])
