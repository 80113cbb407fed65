"""Registration without the training-data part, or without something that it needs."""

import subprocess
import sys

import pytest
from conftest import ROOT

from lexitally import oracle, queries


@pytest.mark.parametrize("missing", ["public_tokenizers", "tokenizers.nothing", "ahocorasick", "lexitally.llm", "corpus_pipeline"])
def test_core_queries_stay(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; "
            "print(*e.queries()); print(*e.oracle_sql())")
    found = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.splitlines()
    names, sql = (set(line.split()) for line in found[-2:])
    assert set(queries.QUERIES) <= names and set(oracle.SQL) <= sql
    if "." not in missing or missing == "lexitally.llm":
        assert (names, sql) == (set(queries.QUERIES), set(oracle.SQL))
