"""Every query against its SQL."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from compare import difference

import __spark_entry__ as entry
from workload.oracle import ORACLE
from workload.queries import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    assert difference(frame, sf_dir, ORACLE[name]) is None
    check_plan(frame._jdf.queryExecution().executedPlan().toString())


def check_plan(plan):
    """No cross join, and no window over all rows."""
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # What runs before the final plan is listed again in it as the initial one.
    lines = plan.split("== Initial Plan ==")[-1].splitlines()
    for at, line in enumerate(lines):
        # A single partition is for totals and for the offsets of numbering.
        if "Exchange SinglePartition" in line:
            assert "Aggregate" in lines[at + 1]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_flagship(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0
    assert {"movie", "label", "rank", "save_path"} <= set(rows.columns)


def test_entry_without_the_training_data_package(tmp_path):
    """The operators for training data and their pipeline can be taken out as a whole."""
    root = Path(entry.__file__).parent
    shutil.copytree(root / "castframe", tmp_path / "castframe", ignore=shutil.ignore_patterns("llm"))
    (tmp_path / "castframe" / "llm" / "__pycache__").mkdir(parents=True)
    shutil.copytree(root / "workload", tmp_path / "workload")
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(*e.queries())"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    assert set(said.stdout.split()) == set(QUERIES)
