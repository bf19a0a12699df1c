"""Every registered query against its SQL, on the smallest tables; and the entry file without its optional part."""

import math
import os
import re
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from trackset.plans import registry

SF = "/root/testdata/sf0.001"
REPO = Path(__file__).parent.parent


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{SF}/lineitem.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, name):
    df = registry.QUERIES[name](spark, SF)
    rows = Counter(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    if name not in registry.ORACLE_SQL:
        assert rows
        return
    found = db.sql(registry.ORACLE_SQL[name])
    order = [found.columns.index(c) for c in sorted(df.columns)]
    assert sorted(found.columns) == sorted(df.columns)
    assert rows == Counter(tuple(plain(r[i]) for i in order) for r in found.fetchall())
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}
    assert {c: kinds[k] for c, k in df.dtypes} == dict(zip(found.columns, map(str, found.types)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["q_inside_px", "q_records_forward"])
def test_no_masks_go_to_the_driver(spark, name):
    """Masks and boxes as intervals take far more memory than Spark's estimate, so no join may broadcast them."""
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    sent = re.findall(r"\) BroadcastExchange\nInput[^:]*: \[(.*)\]", plan)
    assert sent and not [s for s in sent if re.search(r"\b(box|mask|fwd|bwd)#", s)]


def test_entry_without_the_optional_part(tmp_path):
    for p in REPO.iterdir():
        if p.name not in (".git", "corpus_pipeline.py", "tests"):
            (shutil.copytree if p.is_dir() else shutil.copy)(p, tmp_path / p.name)
    shutil.rmtree(tmp_path / "trackset" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); assert not [n for n in q if n.startswith('op') or n == 'pipeline']; print(len(q))"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) == len(registry.QUERIES)


def test_nothing_else_imports_the_optional_part():
    for p in (REPO / "trackset").rglob("*.py"):
        if "llm" not in p.relative_to(REPO / "trackset").parts:
            assert not re.search(r"^\s*(from|import)\s.*\bllm\b", p.read_text(), re.M), p
