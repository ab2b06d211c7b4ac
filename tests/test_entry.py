"""The entry works whether or not the optional part is there."""

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n.startswith('op') for n in q), set(e.oracle_sql()) <= set(q))"


def counted(where, first=""):
    done = subprocess.run([sys.executable, "-c", first + COUNT], cwd=where, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": f"{where}:{os.environ.get('PYTHONPATH', '')}"})
    assert done.returncode == 0, done.stderr
    return done.stdout.split()[-3:]


@pytest.mark.parametrize("left", [None, "__pycache__", "empty"])
def test_entry_without_the_optional_part(tmp_path, left):
    """Also where a folder with nothing but a cache, or nothing at all, is left of it."""
    where = tmp_path / "repo"
    shutil.copytree(HERE, where, ignore=shutil.ignore_patterns(".git", "tests"))
    llm = where / "brightvault" / "llm"
    shutil.rmtree(llm, ignore_errors=True)
    (where / "corpus_pipeline.py").unlink(missing_ok=True)
    if left:
        (llm / ("__pycache__" if left == "__pycache__" else "")).mkdir(parents=True)
    n, operators, known = counted(str(where))
    assert int(n) > 150 and operators == "0" and known == "True"


@pytest.mark.parametrize("package", ["xxhash", "tokenizers"])
def test_entry_without_a_package_of_the_optional_part(package):
    n, operators, known = counted(HERE, f"import sys; sys.modules[{package!r}] = None; ")
    assert int(n) > 150 and operators in ("0", "13") and known == "True"
