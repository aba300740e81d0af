import glob
import math
import os
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E

ROOT = Path(__file__).resolve().parents[1]


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return tuple(_plain(x) for x in v) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in glob.glob(f"{data}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_equals_its_sql(spark, data, duck, name):
    df = E.queries()[name](spark, data)
    cols = sorted(df.columns)
    r = duck.sql(E.oracle_sql()[name])
    assert sorted(r.columns) == cols
    at = [r.columns.index(c) for c in cols]
    want = Counter(repr(tuple(_plain(row[i]) for i in at)) for row in r.fetchall())
    assert Counter(repr(tuple(_plain(x) for x in row)) for row in df.select(*cols).collect()) == want


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_query_runs(spark, data, name):
    df = E.queries()[name](spark, data)
    assert df.columns and df.count() >= 0


def test_entry(spark, data):
    assert E.entry(spark).count() > 0


def test_core_stands_without_the_subpackage(tmp_path):
    """Both folders deleted: what is left imports, registers its queries and passes its tests (a part of them here)."""
    for part in ("blattwerk", "tests", "__spark_entry__.py"):
        source = ROOT / part
        if source.is_dir():
            shutil.copytree(source, tmp_path / part, ignore=lambda d, names: [n for n in names if n in ("llm", "__pycache__")])
        else:
            shutil.copy(source, tmp_path / part)
    code = "import __spark_entry__ as e; q = e.queries(); assert e.llm is None and len(q) > 140 and not [n for n in q if n[0] == 'p' and n[1:2].isdigit() and n != 'p4_found']"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=env)
    subprocess.run([sys.executable, "-m", "pytest", "-q", "-x", "tests/test_history.py", "tests/test_text.py", "tests/test_files.py"], cwd=tmp_path, check=True, env=env)


def test_a_broken_subpackage_is_not_passed_over(tmp_path):
    shutil.copytree(ROOT / "blattwerk", tmp_path / "blattwerk", ignore=lambda d, names: [n for n in names if n in ("llm", "__pycache__")])
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "blattwerk" / "llm").mkdir()
    (tmp_path / "blattwerk" / "llm" / "__init__.py").write_text("")
    (tmp_path / "blattwerk" / "llm" / "queries.py").write_text("import no_such_library\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, capture_output=True, text=True, check=False)
    assert done.returncode and "no_such_library" in done.stderr
