"""The library and its entry module work without the corpus operators and their pipeline."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_corpus_operators(tmp_path):
    keep = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "tests")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=keep)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and all(n.startswith('q_') for n in q), sorted(q); assert set(e.oracle_sql()) <= set(q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[-1]) >= 96


def test_entry_without_what_the_corpus_operators_import():
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; q = e.queries(); assert q and all(n.startswith('q_') for n in q), sorted(q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0 and "public_tokenizers" in done.stderr, done.stderr


def test_the_other_tests_pass_without_the_corpus_operators(tmp_path):
    """Both folders and the pipeline deleted: all other tests are collected, and the quick ones run."""
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    env = {**os.environ, "PYTHONPATH": ""}
    every = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q"], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=300, env=env)
    assert every.returncode == 0, every.stdout[-2000:]
    some = subprocess.run([sys.executable, "-m", "pytest", "tests/test_functions.py", "-q", "-x"], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=600, env=env)
    assert some.returncode == 0, some.stdout[-2000:]


def test_nothing_else_imports_the_corpus_operators():
    for folder, _, names in os.walk(os.path.join(ROOT, "relprep")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf8") as f:
                        assert "relprep.llm" not in f.read(), name
