"""The driver's entry without the optional part, whatever it is that cannot be imported."""
import sys
import types

import pytest

import __spark_entry__ as E
from roomlake.plans.contract import QUERIES


@pytest.mark.parametrize("broken", [None, types.ModuleType("corpus_pipeline")])
def test_core_queries_without_the_optional_part(monkeypatch, broken):
    """The module is missing, or lacks what is imported from it (as if one of its libraries were not there)."""
    monkeypatch.setitem(sys.modules, "corpus_pipeline", broken)
    assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) == set(QUERIES)
