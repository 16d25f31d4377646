import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CHECK = """
import __spark_entry__ as e
names, sql = e.queries(), e.oracle_sql()
assert "gopher_quality" in names and set(sql) <= set(names)
assert not any(n == "pipeline" or n.startswith("op") and n[2].isdigit() for n in names)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").getOrCreate()
assert e.entry(spark).columns
"""


def test_entry_without_the_optional_subpackage(tmp_path):
    """Both folders and the pipeline are deleted, or the folders alone: the other queries are there and nothing raises."""
    for gone in (("corpus_pipeline.py",), ()):
        copy = tmp_path / f"copy{len(gone)}"
        shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", *gone))
        env = {**os.environ, "PYTHONPATH": str(copy)}
        done = subprocess.run([sys.executable, "-c", CHECK], cwd=copy, env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]


def test_own_import_errors_pass_through(tmp_path, monkeypatch):
    import pytest

    import __spark_entry__ as e

    (tmp_path / "broken_part.py").write_text("import a_module_that_is_nowhere\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    with pytest.raises(ModuleNotFoundError):
        e._optional("broken_part")
    assert e._optional("also_nowhere") is None
