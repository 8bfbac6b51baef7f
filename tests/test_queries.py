"""Every query of the catalogue at the smallest scale, against its SQL where there is one."""

import importlib
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")

catalogue = importlib.import_module("docbridge.plans.catalogue")


def rows(table):
    table = table.select(sorted(table.column_names))
    return sorted(map(repr, (tuple(r.values()) for r in table.to_pylist())))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, DATA).toArrow()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got.num_rows > 0
        return
    want = duck.sql(sql).to_arrow_table()
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_optional_modules_may_be_missing():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("docbridge.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
names = e.queries()
assert len(names) >= 39 and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert set(e.oracle_sql()) <= set(names)
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(entry.__file__))
