"""The driver's entry with and without the corpus operators, in a copy of the repository."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
LISTED = "import __spark_entry__ as e; print(*sorted(e.queries()))"


@pytest.fixture
def copy(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    shutil.copytree(ROOT / "larder", tmp_path / "larder", ignore=shutil.ignore_patterns("__pycache__"))
    return tmp_path


def listed(copy, before=""):
    return subprocess.run([sys.executable, "-c", f"import sys; sys.path.insert(0, '.'); {before}{LISTED}"], cwd=copy, capture_output=True, text=True, check=False)


def test_without_the_corpus_operators(copy):
    shutil.rmtree(copy / "larder" / "llm", ignore_errors=True)
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    got = listed(copy)
    assert got.returncode == 0, got.stderr
    assert "catalogue_dedup" in got.stdout.split() and not any(n.startswith("op") and n[2].isdigit() for n in got.stdout.split())


@pytest.mark.skipif(not (ROOT / "larder" / "llm").is_dir(), reason="the corpus operators are not there")
def test_what_they_need_is_not_passed_over(copy):
    got = listed(copy, "sys.modules['public_tokenizers'] = None; ")
    assert got.returncode != 0 and "public_tokenizers" in got.stderr
    assert "op1_mix_sources" in listed(copy).stdout.split()
