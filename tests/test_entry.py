import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry
from meterloom.plans import stored  # noqa: F401 - adds its queries
from meterloom.plans.catalogue import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TESTDATA}/sf0.001/{t}.parquet'")
    return con


def plain(v):
    return repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, f"{TESTDATA}/sf0.001")
    cols = sorted(df.columns)
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert sorted(tuple(plain(r[c]) for c in cols) for r in df.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 862
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_training_data_subpackage():
    """Nothing but the entry knows of it, and the entry does without."""
    code = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert 'q_gold_hourly' in q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(entry.__file__).parent)
    for p in (Path(entry.__file__).parent / "meterloom").rglob("*.py"):
        if "llm" not in p.parts:
            assert "llm" not in p.read_text(), p
