import pytest

from oracle import assert_same, tables
from posegrain.plans import orientation, pipelines, problems, reference

MODULES = (problems, reference, orientation, pipelines)


@pytest.fixture(scope="module")
def con(data):
    return tables(data)


@pytest.mark.parametrize("name", [n for m in MODULES for n in m.ORACLE])
def test_against_sql(spark, con, data, name):
    m = next(m for m in MODULES if name in m.ORACLE)
    assert_same(spark, con, name, m.QUERIES[name], m.ORACLE[name], data)


@pytest.mark.parametrize("name", [n for m in MODULES for n in m.QUERIES if n not in m.ORACLE])
def test_runs_without_sql(spark, data, name):
    m = next(m for m in MODULES if name in m.QUERIES)
    d = m.QUERIES[name](spark, data)
    assert d.columns and len(set(d.columns)) == len(d.columns)
    assert d.count() > 0


def test_entry_lists_everything():
    import __spark_entry__ as e

    names = e.queries()
    assert {"p3_found", "p4_found", "p5_found"} <= set(names)
    assert set(e.oracle_sql()) <= set(names)
