import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


CODE = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and set(e.oracle_sql()) <= set(q) and not any(n.startswith('op') for n in q), sorted(q)"


def copied(to, *ignored):
    for name in ("strataframe", "__spark_entry__.py", "corpus_pipeline.py"):
        src = os.path.join(ROOT, name)
        if name not in ignored:
            shutil.copytree(src, to / name, ignore=shutil.ignore_patterns("__pycache__", *ignored)) if os.path.isdir(src) else shutil.copy(src, to / name)


def imported(folder):
    done = subprocess.run([sys.executable, "-c", CODE], cwd=folder, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_the_rest_works_without_the_pipeline_operators(tmp_path):
    copied(tmp_path, "llm", "corpus_pipeline.py")
    imported(tmp_path)


def test_the_rest_works_with_what_is_left_of_them(tmp_path):
    copied(tmp_path, "llm", "corpus_pipeline.py")
    (tmp_path / "strataframe" / "llm" / "__pycache__").mkdir(parents=True)
    imported(tmp_path)


def test_the_rest_works_without_what_they_need(tmp_path):
    copied(tmp_path)
    (tmp_path / "xxhash.py").write_text("raise ModuleNotFoundError('No module named xxhash', name='xxhash')")
    imported(tmp_path)


def test_nothing_else_imports_them():
    for folder, _, names in os.walk(os.path.join(ROOT, "strataframe")):
        if not folder.endswith("llm"):
            assert not [n for n in names if n.endswith(".py") and "strataframe.llm" in open(os.path.join(folder, n)).read()]


def test_entry_has_a_stable_schema(spark):
    import __spark_entry__

    if os.path.isdir("/root/testdata/sf0.001"):
        df = __spark_entry__.entry(spark)
        assert df.columns == ["key", "status", "latest", "records"] and df.count() > 0
