import os
import pathlib
import shutil
import subprocess
import sys

import __spark_entry__

ROOT = pathlib.Path(__spark_entry__.__file__).parent


def listed(root):
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(*q)"
    return subprocess.run([sys.executable, "-c", code], cwd=root, env=os.environ | {"PYTHONPATH": str(root)}, capture_output=True, text=True)


def test_entry_without_the_text_operators(tmp_path):
    shutil.copytree(ROOT / "chatmill", tmp_path / "chatmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    done = listed(tmp_path)
    assert done.returncode == 0, done.stderr
    names = set(done.stdout.split())
    assert {"p2_found", "p5_found", "d_near"} <= names and not names & {"p1_found", "p3_found", "p10_found"}


def test_what_the_text_operators_need_is_missed_aloud(tmp_path):
    shutil.copytree(ROOT / "chatmill", tmp_path / "chatmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "chatmill" / "llm").mkdir()
    (tmp_path / "chatmill" / "llm" / "__init__.py").write_text("", encoding="utf-8")
    (tmp_path / "chatmill" / "llm" / "queries.py").write_text("import no_such_module\n", encoding="utf-8")
    done = listed(tmp_path)
    assert done.returncode != 0 and "no_such_module" in done.stderr
