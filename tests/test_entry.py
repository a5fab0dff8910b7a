"""The entry module on a copy of the repository without the training-data folders."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import __spark_entry__ as e
names = set(e.queries())
assert names == set(e.oracle_sql()), names ^ set(e.oracle_sql())
assert "revenue_forecast" in names and not any(n.startswith("op") or n == "pipeline" for n in names - {"ordered_sink"})
from revcast.plans.pipeline import _code_version
print(_code_version())
"""


def run(folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", SCRIPT], cwd=folder, env=env, capture_output=True, text=True, timeout=120)


def test_entry_without_the_training_data_folders(tmp_path):
    """Both llm folders are gone, with or without the pipeline's module, and with or
    without caches left in the package's folder."""
    out = set()
    for left in (("corpus_pipeline.py",), ("corpus_pipeline.py", "caches"), ()):
        folder = tmp_path / ("-".join(left) or "bare")
        shutil.copytree(ROOT, folder, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *(
            () if "corpus_pipeline.py" in left else ("corpus_pipeline.py",))))
        if "caches" in left:
            (folder / "revcast" / "llm" / "__pycache__").mkdir(parents=True)
        done = run(folder)
        assert done.returncode == 0, done.stderr[-2000:]
        out.add(done.stdout)
    assert len(out) == 1
