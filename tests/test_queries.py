"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from asfalto.registry.oracles import ORACLES as SQL
from asfalto.registry.queries import QUERIES
from tests.conftest import SMALL
from tools.check_oracles import compare


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, tables, name):
    assert compare(QUERIES[name](spark, SMALL), tables, SQL[name]).startswith("ok")


def test_entry(spark):
    assert entry(spark).count() > 1
