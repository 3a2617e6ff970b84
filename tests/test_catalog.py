"""Every registered query against its SQL twin, at the smallest scale."""

import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from skytally.catalog.oracles import ORACLES
from skytally.catalog.queries import QUERIES, _ordered_for_one
from tests.conftest import SF_DIR, plan


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return connection


def rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    data = [tuple(r) for r in zip(*columns)]
    assert not any(isinstance(v, float) and math.isnan(v) for r in data for v in r)
    return names, sorted(data, key=lambda r: tuple((v is None, v if v is not None else 0) for v in r))


def test_each_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry_without_the_optional_part():
    """What is left of the folder, or lacks a library, does not stop the rest."""
    code = "import sys; sys.modules['skytally.llm.queries'] = None; import __spark_entry__ as e;"
    code += "print(sorted(e.queries()) == sorted(e.QUERIES), len(e.oracle_sql()) == len(e.ORACLES))"
    root = Path(__file__).resolve().parents[1]
    said = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert said.stdout.split() == ["True", "True"], said.stderr


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    mine = rows(QUERIES[name](spark, SF_DIR).toArrow())
    theirs = duck.sql(ORACLES[name]).arrow()
    theirs = theirs.read_all() if hasattr(theirs, "read_all") else theirs
    assert mine == rows(theirs)


def test_one_task_writes_ranges_that_are_sorted_by_themselves(spark, folder):
    numbers = spark.range(5000).selectExpr("id", "cast((id * 7919) % 5000 AS double) AS arrival")
    lines = _ordered_for_one(numbers, "arrival").selectExpr("cast(arrival AS string) AS value")
    assert "rangepartitioning(arrival" in plan(lines) and "SinglePartition" not in plan(lines)
    lines.write.text(folder("lines"))
    [file] = Path(folder("lines")).glob("part-*")
    assert [float(line) for line in file.read_text().split()] == list(range(5000))


def test_flagship_has_rows(spark):
    assert entry(spark).count() == 10
