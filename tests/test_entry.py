"""Driver contract: entry(), queries() and oracle_sql() agree at sf0.001."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
from lineage_spark.plans.oracle import ORACLE
from lineage_spark.plans.queries import QUERIES
from lineage_spark.session import TABLES
from scripts.check_oracle import _rows, type_diffs

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["n_name", "n_orders", "revenue_cents"]


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"path_table"}
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    srows, scols = df.collect(), df.columns
    rel = duck.sql(entry.oracle_sql()[name])
    dcols, dtypes = rel.columns, rel.types
    drows = rel.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert type_diffs(df.dtypes, dcols, dtypes) == []
    assert len(srows) == len(drows)
    a, b = _rows(scols, srows), _rows(dcols, drows)
    assert hashlib.md5("\n".join(a).encode()).hexdigest() == hashlib.md5("\n".join(b).encode()).hexdigest()


def test_every_query_names_its_survey_ids():
    from lineage_spark.plans.queries import SURVEY_IDS

    assert set(SURVEY_IDS) == set(QUERIES)
    assert all(SURVEY_IDS.values())


def test_workers_import_the_package_from_anywhere(tmp_path):
    """The entry loaded by path, from another folder, in a process of its own: Python workers find the package."""
    import subprocess
    import sys

    script = tmp_path / "run.py"
    script.write_text(f"""
import importlib.util, sys
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("entry_elsewhere", {entry.__file__!r})
loaded = importlib.util.module_from_spec(spec)
spec.loader.exec_module(loaded)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("rows", loaded.queries()["image_files"](spark, {SF!r}).count())
""")
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows " in out.stdout, out.stderr[-2000:]
