"""The registry does without the optional part, and without the modules that part needs."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from tidelog.plans.oracle import ORACLE

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("missing", ["xxhash", "corpus_pipeline", "tidelog.llm"])
def test_the_rest_is_offered_without(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as r; print(*sorted(r.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert set(done.stdout.split()) == set(ORACLE)
