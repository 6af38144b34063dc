"""Every core query with SQL gives the same rows as its SQL on the smallest tables."""

from __future__ import annotations

import math
import os

import pytest
from glyphloom.plans import checks as _  # noqa: F401 - adds its queries
from glyphloom.plans import queries as Q


def rows_of(frame):
    def text(x):
        if x is None or (isinstance(x, float) and math.isnan(x)):
            return ""
        return repr(float(x)) if isinstance(x, float) else str(x)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(text, r)) for r in frame.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def db(sf):
    duckdb = pytest.importorskip("duckdb")
    with duckdb.connect() as c:
        c.execute("SET timezone = 'UTC'")
        for f in os.listdir(sf):
            c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
        yield c


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_same_as_sql(spark, sf, db, name):
    got, want = Q.QUERIES[name](spark, sf).toPandas(), db.execute(Q.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_runs(spark, sf, name):
    assert Q.QUERIES[name](spark, sf).count() > 0


def test_the_core_needs_no_subpackage():
    """Nothing outside it imports the subpackage for training data."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(Q.__file__)))
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    with open(os.path.join(folder, f)) as text:
                        assert "glyphloom.llm" not in text.read()
