"""The entry file must work where the optional corpus part is missing."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).parents[1]


def names(folder: Path) -> set[str]:
    code = "import __spark_entry__ as e; print(*e.queries(), sep='\\n')"
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True, env={"PATH": ""})
    return set(done.stdout.split())


def test_imports_without_the_corpus_part(tmp_path):
    hide = shutil.ignore_patterns("llm", "__pycache__", ".git")
    shutil.copytree(REPO / "fieldhouse", tmp_path / "fieldhouse", ignore=hide)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (REPO / name).exists():
            shutil.copy(REPO / name, tmp_path)
    from fieldhouse.workload import QUERIES

    assert names(tmp_path) == set(QUERIES) and len(QUERIES) >= 158
    (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
    assert names(tmp_path) == set(QUERIES)
