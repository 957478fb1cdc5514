import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import assert_same, tables  # noqa: E402

from posegrain.llm import queries  # noqa: E402


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, data, name):
    if name in queries.ORACLE:
        assert_same(spark, tables(data), name, queries.QUERIES[name], queries.ORACLE[name], data)
    else:
        d = queries.QUERIES[name](spark, data)
        assert len(set(d.columns)) == len(d.columns) and d.count() > 0


def test_nothing_else_imports_this_package():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, files in os.walk(os.path.join(root, "posegrain")):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    assert "posegrain.llm" not in open(os.path.join(folder, f)).read(), f
