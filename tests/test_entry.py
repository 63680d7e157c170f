"""The core queries are offered whatever optional parts can be imported."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from tillstar.catalog.queries import registered

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("hidden", ["ahocorasick", "xxhash", "tillstar.llm", "corpus_pipeline"])
def test_core_queries_without_an_optional_part(hidden):
    code = f"import sys; sys.modules[{hidden!r}] = None; import __spark_entry__ as e; e.oracle_sql(); print(*e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    names = done.stdout.split()
    assert set(registered()) <= set(names), done.stderr[-2000:]
    assert "pipeline" not in names
