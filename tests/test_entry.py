"""Driver contract: entry smoke, one oracle per query, Spark == DuckDB on sf0.001."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from editflow.plans.queries import QUERIES
from tests.conftest import SF0001


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"editor", "editor_type", "activity_span_days", "edits_per_day"} <= set(df.columns)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_optional_part(tmp_path):
    """The entry file imports, with the same other queries, where the optional folders are not there."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(entry.__file__).parent
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "editflow", tmp_path / "editflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(*sorted(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.split() == sorted(QUERIES)


def test_an_import_that_fails_inside_the_optional_part_is_an_error(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(entry.__file__).parent
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "editflow", tmp_path / "editflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "editflow" / "llm").mkdir()
    (tmp_path / "editflow" / "llm" / "__init__.py").write_text("")
    (tmp_path / "editflow" / "llm" / "queries.py").write_text("import no_such_module\n")
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, capture_output=True, text=True)
    assert out.returncode != 0 and "no_such_module" in out.stderr


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else float(f"{v:.12g}")
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF0001}/events.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF0001)
    res = duck.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), d_cols)
