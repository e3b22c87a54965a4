import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest


def test_entry_lists_queries():
    import __spark_entry__ as e

    assert len(e.queries()) > 100 and set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("gone", [["corpus_pipeline.py"], ["tapeworks/llm", "tests/llm"], ["tapeworks/llm", "tests/llm", "corpus_pipeline.py"]])
def test_entry_without_the_training_data_operators(tmp_path, gone):
    root = Path(__file__).resolve().parents[1]
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse"))
    for name in gone:
        if (copy / name).exists():
            shutil.rmtree(copy / name) if (copy / name).is_dir() else (copy / name).unlink()
    data, run = "/root/testdata/sf0.001", "from pyspark.sql import SparkSession; s = SparkSession.builder.master('local[2]').getOrCreate(); print(q['cap_band'](s, '/root/testdata/sf0.001').count())"
    say = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), 'pipeline' in q, any(n.startswith('op1_') for n in q))"
    # one query runs too, where the tables are
    say += f"; {run}" * os.path.isdir(data)
    out = subprocess.run([sys.executable, "-B", "-c", say], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 100 and int(out[1]) > 100 and out[2] == "False" and (out[3] == "True") <= ("tapeworks/llm" not in gone)
    assert not os.path.isdir(data) or int(out[4]) == 200


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables here")
def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
