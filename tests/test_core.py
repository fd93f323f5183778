import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from tallgrass.plans import durable, summaries
from tallgrass.sources.tables import table

TOP = Path(__file__).resolve().parents[1]
DATA = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0


def test_summary_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{DATA}/lineitem.parquet'")
    expected = sorted(con.execute(summaries.SHIPPED_BY_STATUS_SQL).fetchall())
    found = summaries.shipped_by_status(spark, DATA)
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_stash_is_read_back_from_the_shared_folder(spark):
    kept = durable.stash(spark.range(5), "numbers")
    assert kept.stash_path.startswith(durable.shared_dir(spark))
    assert sorted(r.id for r in kept.collect()) == [0, 1, 2, 3, 4]
    durable.discard(kept)
    with pytest.raises(Exception):
        kept.count()


def test_passing_results_are_deleted(spark):
    with durable.passing(spark) as outer:
        with durable.passing(spark) as keep:
            gone, kept, passed = (durable.stash(spark.range(3), f"passing-{k}") for k in range(3))
            keep(kept, passed)
        assert kept.count() == passed.count() == 3
        with pytest.raises(Exception):
            gone.count()
        outer(passed)
    assert passed.count() == 3
    with pytest.raises(Exception):
        kept.count()


def test_a_cluster_must_name_its_shared_folder():
    class Session:
        conf = {}

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        durable.shared_dir(Session)


def test_table_keeps_columns(spark):
    assert {"doc_id", "text"} <= set(table(spark, DATA + "/", "documents").columns)


def test_the_rest_works_without_the_training_data_subpackage(tmp_path):
    """A copy without that subpackage and its pipeline imports and keeps the other queries."""
    import shutil

    shutil.copytree(TOP / "tallgrass", tmp_path / "tallgrass", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(TOP / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert list(e.queries()) == list(e.oracle_sql()) == ['shipped_by_status']"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
