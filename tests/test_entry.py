"""The driver's entry points: every query runs, gives the rows of its SQL, and works without the training-data subpackage."""

import os
import subprocess
import sys
from pathlib import Path

import pandas as pd
import pytest

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables")

import __spark_entry__ as entry
from palisade.plans import catalog


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)].astype(object)
    text = lambda v: "" if v is None or v is pd.NA or v != v else f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(text, r)) for r in df.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    if name not in catalog.ORACLES:
        assert len(got)
        return
    want = duck.execute(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).columns == ["kind", "n", "n_values"]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_library_does_not_need_the_training_data_operators(tmp_path):
    root = Path(entry.__file__).parent
    for path in root.rglob("*.py"):
        part = path.relative_to(root)
        if part.parts[0] in ("palisade", "__spark_entry__.py", "bench.py") and part.parts[:2] != ("palisade", "llm"):
            target = tmp_path / part
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(path.read_bytes())
            assert part.name == "__spark_entry__.py" or "palisade.llm" not in path.read_text()
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [k for k in q if k.startswith('op1_') or k == 'pipeline']; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": ""}, check=True)
