"""The entry module with and without the optional training-data parts."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as E; q, o = E.queries(), E.oracle_sql(); print(sorted(q)); assert set(o) <= set(q)"


def names(home):
    env = {**os.environ, "PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"}
    run = subprocess.run([sys.executable, "-c", SHOW], cwd=home, env=env, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    return eval(run.stdout)


def copy(home, *without):
    home.mkdir()
    shutil.copytree(os.path.join(ROOT, "pitstop"), home / "pitstop",
                    ignore=lambda d, found: [x for x in found if x == "__pycache__" or os.path.join(d, x).endswith(without or "?")])
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(ROOT, name)) and name not in without:
            shutil.copy(os.path.join(ROOT, name), home)
    return home


@pytest.mark.parametrize("without", [("pitstop/llm",), ("pitstop/llm", "corpus_pipeline.py")])
def test_the_rest_imports_without_the_optional_parts(tmp_path, without):
    from pitstop import registry
    assert names(copy(tmp_path / "repo", *without)) == sorted(registry.QUERIES)


def test_a_broken_part_is_not_passed_over(tmp_path):
    home = copy(tmp_path / "repo", "pitstop/llm")
    (home / "pitstop" / "llm").mkdir()
    (home / "pitstop" / "llm" / "__init__.py").write_text("")
    (home / "pitstop" / "llm" / "queries.py").write_text("import a_module_that_is_not_there\n")
    with pytest.raises(AssertionError, match="a_module_that_is_not_there"):
        names(home)
