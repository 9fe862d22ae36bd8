"""Every registered query, run through the entry module at the smallest size and held against its SQL in another engine."""

import ast
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from quern import queries as core

from .conftest import ROOT

SF = "/root/testdata/sf0.001"


def test_no_module_name_is_bound_twice():
    for path in glob.glob(os.path.join(ROOT, "quern", "*.py")):
        seen = set()
        for node in ast.parse(open(path).read()).body:
            names = [node.name] if isinstance(node, (ast.FunctionDef, ast.ClassDef)) else [x.id for t in getattr(node, "targets", []) for x in ast.walk(t) if isinstance(x, ast.Name)]
            for name in names:
                assert name not in seen, f"{path} binds {name} twice"
                seen.add(name)


def test_a_query_cannot_be_registered_twice():
    with pytest.raises(ValueError):
        core.query()(core.QUERIES["classify_full"])


def _shape(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda x: None if x is None or isinstance(x, float) and math.isnan(x) else round(float(x), 6) if isinstance(x, float) else x
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.fixture(scope="module")
def other():
    c = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return c


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query_equals_its_sql(spark, other, name):
    assert name in core.ORACLES
    got = E.queries()[name](spark, SF)
    want = other.execute(E.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert _shape(got.collect(), got.columns) == _shape(want.fetchall(), columns)
