"""The entry file without the text operators, which an installation may leave out."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

from checks.queries import QUERIES

REPO = Path(__file__).resolve().parent.parent


def test_core_queries_stay_without_the_text_operators(tmp_path):
    for folder in ("guildmart", "checks"):
        shutil.copytree(REPO / folder, tmp_path / folder, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for file in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (REPO / file).exists():
            shutil.copy(REPO / file, tmp_path / file)
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    queries, oracle = (line.split() for line in out.stdout.splitlines())
    assert queries == oracle == sorted(QUERIES)
