import os
import subprocess
import sys
from pathlib import Path

STORE = """
from pyspark.sql import SparkSession
from formloom.llm.common import discard, materialize
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").config("spark.checkpoint.dir", "file://{shared}").getOrCreate()
out = materialize(spark.range(10), "ids")
assert sorted(r["id"] for r in out.collect()) == list(range(10)), out.collect()
discard(out)
"""


def test_stored_tables_start_no_process_in_the_driver(tmp_path):
    """A process that begins counts all of the driver's memory once more; the committer's folders and marker took one each."""
    tools, log = tmp_path / "tools", tmp_path / "log"
    tools.mkdir()
    log.touch()
    (tools / "chmod").write_text(f'#!/bin/sh\necho "$*" >> {log}\nexec /bin/chmod "$@"\n')
    (tools / "chmod").chmod(0o755)
    repo = Path(__file__).resolve().parents[2]
    env = os.environ | {"PATH": f"{tools}:{os.environ['PATH']}", "PYTHONPATH": f"{repo}:{os.environ.get('PYTHONPATH', '')}"}
    subprocess.run([sys.executable, "-c", STORE.format(shared=tmp_path / "shared")], env=env, cwd=tmp_path, check=True, timeout=120)
    started = log.read_text().splitlines()
    assert any("/part-" in x for x in started)  # those of the tasks are seen
    assert [x for x in started if "/formloom" in x and "/_temporary/0/" not in x] == []  # tasks make what lies below
    assert list((tmp_path / "shared/formloom").iterdir()) == []
