from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from checks.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("hidden", ["public_tokenizers", "plaza.llm", "corpus_pipeline"])
def test_the_entry_works_without_what_the_optional_part_needs(hidden):
    code = (
        f"import sys; sys.modules[{hidden!r}] = None; import __spark_entry__ as e; "
        "print(len(e.queries()), len(e.oracle_sql()), any(q.startswith('op') or q == 'pipeline' for q in e.queries()))"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(QUERIES))] * 2 + ["False"], done.stderr
