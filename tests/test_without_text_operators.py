"""The repository stands without the text operators: they are deleted from a copy."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import __spark_entry__ as entry, bench, ridewright.plans.batch, ridewright.plans.events
names = set(entry.queries())
assert names and names == set(entry.oracle_sql()), names ^ set(entry.oracle_sql())
assert not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in names)
"""


def run(folder):
    return subprocess.run([sys.executable, "-c", CODE], cwd=folder, capture_output=True, text=True, timeout=120)


def test_import_without_them(tmp_path):
    copy = tmp_path / "copy"
    skipped = shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py")
    shutil.copytree(ROOT, copy, ignore=skipped)
    done = run(copy)
    assert done.returncode == 0, done.stderr
    # the pipeline's file alone, or an empty folder in the place of the operators, changes nothing
    pipeline = os.path.join(ROOT, "corpus_pipeline.py")
    (copy / "corpus_pipeline.py").write_text(open(pipeline).read() if os.path.exists(pipeline) else "import ridewright.llm")
    (copy / "ridewright" / "llm" / "__pycache__").mkdir(parents=True)
    done = run(copy)
    assert done.returncode == 0, done.stderr
