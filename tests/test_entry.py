"""The entry points from another folder, without libraries and without the text operators."""

from __future__ import annotations

import subprocess
import sys

import pytest
from conftest import REPO

HEAD = f"import sys; sys.path.insert(0, {str(REPO)!r})\n"


def run_elsewhere(tmp_path, code):
    """Run ``code`` in a process of its own that starts in another folder."""
    script = tmp_path / "script.py"
    script.write_text(HEAD + code)
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout.strip().splitlines()


def test_workers_can_import_the_package_from_another_folder(tmp_path):
    code = """
from pyspark.sql import SparkSession
from ledgerstar.contracts import quoted
from ledgerstar.session import ship_package
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
ship_package(spark)
ship_package(spark)
print(spark.sparkContext.parallelize(["a`b"], 1).map(quoted).collect()[0])
"""
    assert run_elsewhere(tmp_path, code)[-1] == "`a``b`"


@pytest.mark.parametrize("absent", ["tiktoken", "public_tokenizers", "corpus_pipeline", "ledgerstar.llm"])
def test_other_queries_work_without(tmp_path, absent):
    code = f"""
sys.modules[{absent!r}] = None
import warnings
warnings.simplefilter("ignore")
import __spark_entry__ as entry
print("mart_billing" in entry.queries(), any(n.startswith("op") for n in entry.queries()), set(entry.oracle_sql()) <= set(entry.queries()))
"""
    assert run_elsewhere(tmp_path, code)[-1] == "True False True"


def test_a_broken_core_is_an_error(tmp_path):
    code = """
sys.modules["ledgerstar.contracts"] = None
try:
    import __spark_entry__
except ModuleNotFoundError as error:
    print(error.name)
"""
    assert run_elsewhere(tmp_path, code)[-1] == "ledgerstar.contracts"
