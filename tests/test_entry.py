"""The registered queries against their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from quire.plans import queries as core

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in os.listdir(DIR):
        c.execute(f"create view {t.split('.')[0]} as select * from '{DIR}/{t}'")
    return c


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_query_equals_sql(spark, duck, name):
    df = core.queries()[name](spark, DIR)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert name == "log_unwrapped"
        return
    got = duck.execute(sql)
    names = [x[0] for x in got.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted((tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in got.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in sorted(names)) for r in rows), key=repr) == expected


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["book", "revision", "field", "change"]


def test_nothing_else_imports_the_optional_subpackage():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, _, files in os.walk(os.path.join(root, "quire")):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    with open(os.path.join(folder, f)) as h:
                        assert "quire.llm" not in h.read(), f


def test_queries_run_from_another_folder(tmp_path):
    """Python workers that cannot import the package get it sent."""
    import subprocess
    import sys

    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "import __spark_entry__ as e\nfrom quire.session import local_session\n"
        "s = local_session(2)\nprint('rows', e.queries()['log_unwrapped'](s, sys.argv[2]).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    root = os.path.dirname(os.path.abspath(entry.__file__))
    done = subprocess.run([sys.executable, "-c", code, root, DIR], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-800:]
