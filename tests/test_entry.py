import os
import re
import shutil
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def test_every_operator_is_registered():
    names = list(entry.queries())
    assert {int(m[1]) for x in names if (m := re.match(r"op(\d+)_", x))} == set(range(1, 14))
    assert "pipeline" in names


def names_of(folder):
    return subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__ as e; print(*e.queries())"], cwd=folder, env=os.environ | {"PYTHONPATH": str(folder)}, capture_output=True, text=True)


def test_absent_or_broken_subpackage(tmp_path):
    """Without the subpackage the other queries stay; one that can't be imported is an error, not an absence."""
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/tariffa", tmp_path / "tariffa", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    found = names_of(tmp_path)
    assert found.returncode == 0 and "three_stage_median" in found.stdout and "op8_" not in found.stdout
    shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)
    (tmp_path / "tariffa" / "llm").mkdir()  # what caches of a removed package leave
    assert names_of(tmp_path).stdout == found.stdout
    shutil.copytree(f"{ROOT}/tariffa/llm", tmp_path / "tariffa" / "llm", dirs_exist_ok=True, ignore=shutil.ignore_patterns("__pycache__"))
    assert "op8_prefix_tree" in names_of(tmp_path).stdout
    with open(tmp_path / "tariffa" / "llm" / "chat.py", "a") as f:
        f.write("\nfrom tariffa.llm.bpe import gone\n")
    found = names_of(tmp_path)
    assert found.returncode and "cannot import name 'gone'" in found.stderr
