"""The driver's contract, and the core without the llm subpackage."""

import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["canonical_urls", "clean_pages", "gate_verdicts", "snapshot_upsert", "p3_found", "schedule_gate", "soft_duplicates", "extraction_validate", "rule_validate", "ladder_run", "process_candidates"])
def test_queries_equal_their_sql(spark, data, name):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in Path(data).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    want = c.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    rows = sorted([str(dict(sorted(zip(columns, r)))) for r in want.fetchall()])
    got = entry.queries()[name](spark, data)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(str(dict(sorted(r.asDict().items()))) for r in got.collect()) == rows


def test_nothing_in_the_core_names_the_llm_subpackage():
    for path in [*(ROOT / "vaglio").rglob("*.py"), *(ROOT / "tests").glob("*.py")]:
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"^\s*(?:from|import)\s+vaglio\.llm", path.read_text(), re.M), path


def test_core_imports_without_it():
    code = "import sys; sys.modules['vaglio.llm'] = None; import vaglio.plans.catalogue as c; assert c.QUERIES"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=False).returncode == 0
