"""Spark queries against DuckDB on the smallest star-schema data."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_point
from curbside.star.oracles import ORACLES
from curbside.star.queries import QUERIES
from curbside.plans.experiments import plan_text

duckdb = pytest.importorskip("duckdb")
FOLDER = entry_point.SMOKE_DIR
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no star-schema data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def canonical(arrow) -> tuple[list[str], list[tuple]]:
    names = sorted(arrow.column_names)
    columns = [arrow.column(n).to_pylist() for n in names]
    values = [tuple(0.0 if v == 0 else v for v in row) for row in zip(*columns)]
    return names, sorted(values, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    ours = entry_point.queries()[name](spark, FOLDER).toArrow()
    theirs = duck.execute(entry_point.oracle_sql()[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in ours.schema} == {f.name: str(f.type) for f in theirs.schema}
    assert canonical(ours) == canonical(theirs)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_trends_read_only_their_days(spark):
    """The registered query runs on a table stored by day, and its filter is on the partition column."""
    plan = plan_text(entry_point.queries()["monthly_trends"](spark, FOLDER))
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert filters and "pickup_date" in filters[0] and "1996-01-01" in filters[0]
