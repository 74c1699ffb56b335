"""The registered queries where parts of the corpus folder's needs are absent."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["regex", "public_tokenizers", "cohortloom.llm", "corpus_pipeline"])
def test_other_queries_survive_a_missing_module(missing):
    code = (
        "import sys, warnings\n"
        f"sys.modules[{missing!r}] = None\n"
        "import __spark_entry__ as entry\n"
        "names = set(entry.queries())\n"
        "assert {'registry_hcv', 'registry_hiv', 'registry_sud', 'stored_results'} <= names\n"
        "assert not any(n.startswith('op') for n in names) and 'pipeline' not in names\n"
        "assert set(entry.oracle_sql()) <= names\n"
    )
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr
    assert (f"{missing}" in done.stderr) == (missing in ("regex", "public_tokenizers"))


def test_a_broken_library_module_is_not_passed_over():
    code = "import sys\nsys.modules['cohortloom.rules.keywords'] = None\nimport __spark_entry__\n"
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120
    )
    assert done.returncode != 0 and "keywords" in done.stderr
