"""Every query with SQL gives the same rows in DuckDB; the others run."""

import pytest
from oracle import connect, same

from motionloom.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf, con, name):
    same(QUERIES[name](spark, sf).toPandas(), con.sql(SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry_without_the_optional_part(tmp_path):
    """The entry module and its queries work where the optional subpackage and the pipeline are absent."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "motionloom", tmp_path / "motionloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and set(e.oracle_sql()) <= set(q) and not any(k.startswith('op') for k in q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
