import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = "import __spark_entry__ as e; print('NAMES', sorted(n for n in e.queries() if n.startswith('op') or n == 'pipeline'), len(e.queries()))"


def load(folder, **env):
    return subprocess.run([sys.executable, "-W", "always", "-c", PROBE], cwd=folder, env={**os.environ, "PYTHONPATH": str(folder), **env}, capture_output=True, text=True)


@pytest.fixture
def copy(tmp_path):
    for name in ("ledgerloom", "__spark_entry__.py", "corpus_pipeline.py"):
        source, target = os.path.join(ROOT, name), tmp_path / name
        if os.path.isdir(source):
            shutil.copytree(source, target, ignore=shutil.ignore_patterns("__pycache__", "llm"))
        elif os.path.exists(source) and name != "corpus_pipeline.py":
            shutil.copy(source, target)
    return tmp_path


def test_without_the_subpackage_the_rest_is_there(copy):
    found = load(copy)
    assert "NAMES [] 1" in found.stdout, found.stderr


def stand_in(copy, body):
    (copy / "corpus_pipeline.py").write_text("ORACLE_SQL = None\ndef run(spark, sf_dir): pass\n")
    (copy / "ledgerloom" / "llm").mkdir()
    (copy / "ledgerloom" / "llm" / "__init__.py").write_text("")
    (copy / "ledgerloom" / "llm" / "queries.py").write_text(body + "\nQUERIES, ORACLES = {'op1_x': lambda s, d: None}, {}\n")


def test_an_error_inside_the_subpackage_is_raised(copy):
    stand_in(copy, "from ledgerloom.llm import no_such_module")
    found = load(copy)
    assert found.returncode and "no_such_module" in found.stderr
    (copy / "ledgerloom" / "llm" / "queries.py").write_text("import ledgerloom.nothing")
    assert load(copy).returncode


def test_a_missing_optional_library_leaves_the_rest(copy):
    stand_in(copy, "raise ModuleNotFoundError(\"No module named 'xxhash'\", name='xxhash')")
    found = load(copy)
    assert "NAMES [] 1" in found.stdout and "xxhash is not installed" in found.stderr
    (copy / "ledgerloom" / "llm" / "queries.py").write_text("QUERIES, ORACLES = {'op1_x': lambda s, d: None}, {}")
    assert "NAMES ['op1_x', 'pipeline'] 1" in load(copy).stdout
