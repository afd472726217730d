"""The registry without the corpus operators, or with a package of theirs missing."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), len(o), sum(n.startswith('op') or n == 'pipeline' for n in q))"


def said(at, code=SAY):
    out = subprocess.run([sys.executable, "-c", code], cwd=at, capture_output=True, text=True, timeout=300, env={**os.environ, "PYTHONPATH": at})
    assert out.returncode == 0, out.stderr
    return [int(x) for x in out.stdout.split()]


def test_without_the_corpus_operators(tmp_path):
    at = str(tmp_path / "repo")
    shutil.copytree(ROOT, at, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    n, sql, corpus = said(at)
    assert n > 90 and sql > 75 and corpus == 0
    os.remove(f"{at}/corpus_pipeline.py")
    assert said(at) == [n, sql, 0]


def test_with_a_package_missing():
    n, sql, corpus = said(ROOT, "import sys; sys.modules['tiktoken'] = None; " + SAY)
    assert n > 90 and corpus == 0
