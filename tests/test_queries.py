import os

import duckdb
import pytest

from offerweave.plans import catalog_queries as cq

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(str([f"{r[k]:.6f}" if isinstance(r[k], float) else str(r[k]) for k in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(cq.QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = cq.QUERIES[name](spark, SF)
    got = canon([tuple(r) for r in df.collect()], df.columns)
    found = duck.execute(cq.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names) and got == canon(found.fetchall(), names)


def test_entry_without_the_llm_folder(spark, tmp_path):
    import shutil
    import subprocess
    import sys

    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{top}/offerweave", tmp_path / "offerweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{top}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert e.queries().keys() == e.oracle_sql().keys() and len(e.queries()) > 80"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
